"""Rule table: schema, validation and the block structure of a rule set.

A rule table is small by nature (a hand-written file of rules). It is
collected to the driver once and compiled into column expressions; the
responses never leave the executors. ``max_rules`` can bound it (default: no bound).

Blank cells of a flat file come as NaN. As in the reference a NaN is not a missing cell: as a
literal it reads as a number that compares false, as an action it is unsupported. Keys and variable names of NaN
count as blank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Rule-table column names.
RULE_COLUMNS = [
    "new_variable",
    "pass_number",
    "action",
    "detail",
    "survey_id_a",
    "survey_id_a_value_1",
    "survey_id_a_value_2",
    "survey_id_b",
    "survey_id_b_value",
    "survey_id_c",
    "survey_id_c_value",
    "survey_id_d",
    "survey_id_d_value",
    "fill_with_this",
    "else",
]

RULE_SCHEMA = T.StructType(
    [T.StructField("rule_no", T.IntegerType(), False)]
    + [
        T.StructField(c, T.IntegerType() if c == "pass_number" else T.StringType(), True)
        for c in RULE_COLUMNS
    ]
)

@dataclass(frozen=True)
class Rule:
    rule_no: int
    new_variable: str
    pass_number: int
    action: str | None
    detail: str | None
    a: str | None = None
    a_value_1: str | None = None
    a_value_2: str | None = None
    b: str | None = None
    b_value: str | None = None
    c: str | None = None
    c_value: str | None = None
    d: str | None = None
    d_value: str | None = None
    fill_with_this: str | None = None
    else_value: str | None = None

    def keys(self) -> list[str | None]:
        return [self.a, self.b, self.c, self.d]

    def values(self) -> list[str | None]:
        return [self.a_value_1, self.b_value, self.c_value, self.d_value]


@dataclass
class RuleSet:
    rules: list[Rule]
    variables: list[str] = field(default_factory=list)
    max_pass: int = -1
    _blocks: dict[tuple[int, str], list[Rule]] = field(init=False, repr=False)

    def __post_init__(self):
        self._blocks = {}
        for r in self.rules:
            self._blocks.setdefault((r.pass_number, r.new_variable), []).append(r)

    def block(self, pass_number: int, variable: str) -> list[Rule]:
        return self._blocks.get((pass_number, variable), [])


def _is_nan(v) -> bool:
    return isinstance(v, float) and math.isnan(v)


def _text(v) -> str | None:
    """A cell's text; NaN keeps its Python text "nan"."""
    return None if v is None else str(v)


def _name(v) -> str | None:
    """A key or variable name; a blank cell is none."""
    return None if _is_nan(v) else _text(v)


def _from_mapping(i: int, row: dict) -> Rule:
    pn = row.get("pass_number")
    if pn is None or _is_nan(pn):
        raise ValueError(f"rule {i}: pass_number is required")
    if int(pn) != float(pn):
        raise ValueError(f"rule {i}: pass_number must be an integer, got {pn!r}")
    rule_no = row.get("rule_no")
    names = {f: _name(row.get(c)) for f, c in (("new_variable", "new_variable"), ("a", "survey_id_a"), ("b", "survey_id_b"),
                                               ("c", "survey_id_c"), ("d", "survey_id_d"))}
    cells = {f: _text(row.get(c)) for f, c in (("action", "action"), ("detail", "detail"), ("a_value_1", "survey_id_a_value_1"),
                                               ("a_value_2", "survey_id_a_value_2"), ("b_value", "survey_id_b_value"), ("c_value", "survey_id_c_value"),
                                               ("d_value", "survey_id_d_value"), ("fill_with_this", "fill_with_this"), ("else_value", "else"))}
    return Rule(rule_no=int(rule_no) if rule_no is not None else i, pass_number=int(pn), **names, **cells)


def load_rules(rules, max_rules: int | None = None) -> RuleSet:
    """Normalise a rule table (Spark DataFrame, pandas frame or list of dicts).

    Row order defines rule order (``rule_no`` when given; a Spark table has no row order, so it must have one). Variables are
    listed in order of first appearance, rows without a variable are kept
    only for the pass count, as in the reference loop.
    """
    if isinstance(rules, RuleSet):
        return rules
    if isinstance(rules, DataFrame):
        if "rule_no" not in rules.columns:
            raise ValueError("a Spark rule table needs rule_no: the order of rules decides the answer")
        if max_rules is not None and rules.limit(max_rules + 1).count() > max_rules:
            raise ValueError(f"rule table has more than {max_rules} rows")
        rules = rules.orderBy("rule_no")
        rows = [r.asDict() for r in rules.collect()]
    elif hasattr(rules, "to_dict") and hasattr(rules, "columns"):
        rows = rules.to_dict("records")
    else:
        rows = [dict(r) for r in rules]
    if max_rules is not None and len(rows) > max_rules:
        raise ValueError(f"rule table has more than {max_rules} rows")
    missing = [c for c in ("new_variable", "pass_number") if rows and c not in rows[0]]
    if missing:
        raise ValueError(f"rule table lacks columns {missing}")
    parsed = [_from_mapping(i, row) for i, row in enumerate(rows)]
    parsed.sort(key=lambda r: r.rule_no)
    variables = list(dict.fromkeys(r.new_variable for r in parsed if r.new_variable is not None))
    max_pass = max((r.pass_number for r in parsed), default=-1)
    if any(r.pass_number < 0 for r in parsed):
        raise ValueError("pass_number must be >= 0")
    return RuleSet(rules=[r for r in parsed if r.new_variable is not None], variables=variables, max_pass=max_pass)


def rules_dataframe(spark, rows: list[dict]) -> DataFrame:
    """A rule table as a Spark DataFrame with the fixed schema."""
    data = []
    for i, row in enumerate(rows):
        data.append(tuple([row.get("rule_no", i)] + [row.get(c) for c in RULE_COLUMNS]))
    return spark.createDataFrame(data, RULE_SCHEMA)


def rule(new_variable, pass_number, action, detail=None, a=None, A=None, A2=None, b=None, B=None,
         c=None, C=None, d=None, D=None, then=None, otherwise=None) -> dict:
    """Shorthand for one rule row (used by fixtures and tests)."""
    return {
        "new_variable": new_variable,
        "pass_number": pass_number,
        "action": action,
        "detail": detail,
        "survey_id_a": a,
        "survey_id_a_value_1": A,
        "survey_id_a_value_2": A2,
        "survey_id_b": b,
        "survey_id_b_value": B,
        "survey_id_c": c,
        "survey_id_c_value": C,
        "survey_id_d": d,
        "survey_id_d_value": D,
        "fill_with_this": then,
        "else": otherwise,
    }
