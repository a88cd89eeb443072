"""Shared shapes for compiled rules.

A rule compiles to an ordered list of ``(condition, sub)`` branches. The
compiler concatenates the branches of all rules of a block into ONE searched
``CASE``; a rule that does not match simply has no branch that fires, so the
next rule's branches are tried: first-match-wins is CASE fall-through.

``sub`` is the outcome detail: 1 and 4..7 resolve the variable (with the
value registered for that sub), 3 is "data not found", 9 an error that the
reference would raise (quarantined: the variable is dropped for that row).
Outcome 2 ("conditions not met") is the implicit fall-through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from varloom.functions.values import py_float, sql_double, sql_str

RESOLVED = 1
NOT_MET = 2
NOT_FOUND = 3
RESOLVED_ELSE = 4
RESOLVED_ALT = 5
ERROR = 9
RESOLVED_SUBS = (RESOLVED, RESOLVED_ELSE, RESOLVED_ALT)

INTENDED = "intended"
OBSERVED = "observed"


@dataclass(frozen=True)
class Operand:
    """Current version of a key: SQL for presence and number; text and shared helper columns on demand."""

    key: str
    p: str  # BOOLEAN, never null
    n: str  # DOUBLE, Python float() of the text, null if not a number
    extra: Callable[[str], str]  # name of a helper column of this version, added to the plan when asked for

    @property
    def r(self) -> str:
        """STRING, null = JSON null."""
        return self.extra("text")

    @property
    def t(self) -> str:
        """Python ``str(x)`` of the answer (``None`` for a null)."""
        return f"coalesce({self.r}, 'None')"

    @property
    def is_text(self) -> str:
        """BOOLEAN, never null: the answer is a string. Always so in a plan without the answers' kinds."""
        return self.extra("is_text")

    @property
    def listed(self) -> tuple[str, str, str]:
        """Of the answer read as a list of numbers: unreadable (BOOLEAN), how many, their sum; parsed once per version."""
        return self.extra("list_bad"), self.extra("list_count"), self.extra("list_sum")


@dataclass(frozen=True)
class LitVal:
    """A literal from the rule table (``fill_with_this`` / ``else``)."""

    text: str | None

    def r(self) -> str:
        return sql_str(self.text)

    def n(self) -> str:
        return sql_double(None if self.text is None else py_float(self.text))


@dataclass(frozen=True)
class TextVal:
    """A text computed per row (merge, copy)."""

    sql: str


@dataclass(frozen=True)
class NumVal:
    """A number computed per row; ``kind`` picks its text form."""

    sql: str
    kind: str = "float"  # float | int | mean
    own_layer: bool = False  # long, or used several times by its text: computed in a projection of its own


@dataclass
class Compiled:
    branches: list[tuple[str, int]] = field(default_factory=list)
    vals: dict[int, object] = field(default_factory=dict)

    def add(self, cond: str, sub: int) -> Compiled:
        self.branches.append((cond, sub))
        return self


class UnsupportedRule(ValueError):
    pass


def all_present(ops: list[Operand]) -> str:
    return " AND ".join(o.p for o in ops) if ops else "TRUE"


def any_absent(ops: list[Operand]) -> str:
    return "NOT (" + all_present(ops) + ")"


def num_cmp(n_sql: str, op: str, lit: float | None) -> str:
    """Python float comparison: NaN on either side is never equal/ordered."""
    import math

    if lit is None or math.isnan(lit):
        return "FALSE"
    sym = {"equal": "=", "greater_than": ">", "greater_than_equal": ">=",
           "less_than": "<", "less_than_equal": "<="}[op]
    return f"(NOT isnan({n_sql}) AND {n_sql} {sym} {sql_double(lit)})"


def else_usable(else_value: str | None, mode: str) -> bool:
    """Whether a rule's else value resolves the variable."""
    if else_value is None:
        return False
    f = py_float(else_value)
    if mode == OBSERVED:
        return f is None  # only non-numeric text, "" included
    return not (f is not None and f != f)  # anything but NaN
