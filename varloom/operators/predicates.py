"""Conditional rules (P1-P29): comparisons, membership, ranges, null tests.

Every predicate compiles to ordered CASE branches:
``absent -> 3``, then operand checks in the reference's evaluation order,
then ``predicate -> 1 (fill_with_this)``, then, when the else value is
usable, ``TRUE -> 4 (else)``; otherwise the rule falls through (outcome 2).

Operand checks come in three styles, matching how the reference reads a
value before comparing it:

* ``str``   - ``isfloat(str(x))``: null or non-number gives outcome 3;
* ``raw``   - ``isfloat(x)``: null raises (9), non-number gives 3;
* ``float`` - ``float(x)``: null or non-number raises (9).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from varloom.functions.values import py_float, sql_double, sql_str
from varloom.operators.common import (
    ERROR,
    INTENDED,
    NOT_FOUND,
    OBSERVED,
    RESOLVED,
    RESOLVED_ELSE,
    Compiled,
    LitVal,
    Operand,
    any_absent,
    else_usable,
    num_cmp,
)
from varloom.plans.rules import Rule

CONDITIONAL_ACTIONS = ("conditional", "conditional_2", "conditional_3")


@dataclass(frozen=True)
class Term:
    op: str  # equal, greater_than, ..., is_in, is_null
    style: str  # str | raw | float | none (no numeric read)
    lit_style: str  # str | raw | float | none


def _finish(out: Compiled, rule: Rule, pred: str, mode: str) -> Compiled:
    out.add(pred, RESOLVED)
    out.vals[RESOLVED] = LitVal(rule.fill_with_this)
    if else_usable(rule.else_value, mode):
        out.add("TRUE", RESOLVED_ELSE)
        out.vals[RESOLVED_ELSE] = LitVal(rule.else_value)
    return out


def _lit_check(lit: str | None, style: str) -> int | None:
    """Compile-time outcome of reading a literal; None when it reads fine."""
    if style == "none":
        return None
    if lit is None:
        return NOT_FOUND if style == "str" else ERROR
    if py_float(lit) is None:
        return ERROR if style == "float" else NOT_FOUND
    return None


def _operand_checks(o: Operand, style: str) -> list[tuple[str, int]]:
    if style == "str":
        return [(f"{o.n} IS NULL", NOT_FOUND)]
    if style == "raw":
        return [(f"{o.r} IS NULL", ERROR), (f"{o.n} IS NULL", NOT_FOUND)]
    if style == "float":
        return [(f"{o.n} IS NULL", ERROR)]
    return []


def _numeric_in(n_sql: str, lit: str | None) -> str:
    nums = [py_float(x) for x in str(lit).split(",")]
    nums = [x for x in nums if x is not None and not math.isnan(x)]
    if not nums:
        return "FALSE"
    return f"(NOT isnan({n_sql}) AND {n_sql} IN ({', '.join(sql_double(x) for x in nums)}))"


def _term_pred(o: Operand, lit: str | None, op: str, mode: str, null_test: str) -> str:
    if op == "is_in":
        return _numeric_in(o.n, lit) if mode == INTENDED else "FALSE"
    if op == "is_null":
        if mode == INTENDED:
            return f"({o.r} IS NULL OR {o.r} = '')"
        return {"empty_text": f"({o.r} = '')", "never": "FALSE"}[null_test]
    return num_cmp(o.n, op, py_float(lit))


def conjunction(rule: Rule, ref, terms: list[Term], mode: str, *,
                observed_ops: list[str] | None = None, trailing_error: bool = False,
                null_test: str = "never") -> Compiled:
    """Generic ``a op A AND b op B ...`` rule with reference-ordered checks."""
    keys = rule.keys()[: len(terms)]
    lits = rule.values()[: len(terms)]
    if any(k is None for k in keys):
        raise ValueError(f"rule {rule.rule_no}: {rule.detail} needs {len(terms)} keys")
    ops = [ref(k) for k in keys]
    out = Compiled().add(any_absent(ops), NOT_FOUND)
    for i, (o, lit, term) in enumerate(zip(ops, lits, terms)):
        out.branches.extend(_operand_checks(o, term.style))
        last = i == len(terms) - 1
        # observed: the last literal is never read, the broken check raises first
        lit_style = "none" if (trailing_error and mode == OBSERVED and last) else term.lit_style
        fixed = _lit_check(lit, lit_style)
        if fixed is not None:
            out.add("TRUE", fixed)
            return out
    if trailing_error and mode == OBSERVED:
        out.add("TRUE", ERROR)
        return out
    use_ops = observed_ops if (observed_ops and mode == OBSERVED) else [t.op for t in terms]
    preds = [_term_pred(o, lit, op, mode, null_test) for o, lit, op in zip(ops, lits, use_ops)]
    return _finish(out, rule, " AND ".join(preds), mode)


# ---------------------------------------------------------------- single key

def _cond_numeric(op: str) -> Callable:
    def build(rule: Rule, ref, mode: str) -> Compiled:
        return conjunction(rule, ref, [Term(op, "str", "str")], mode)

    return build


def _cond_is_in(rule: Rule, ref, mode: str) -> Compiled:
    o = ref(rule.a)
    items = str(rule.a_value_1).split(",")
    pred = f"{o.t} IN ({', '.join(sql_str(x) for x in items)})"
    return _finish(Compiled().add(f"NOT {o.p}", NOT_FOUND), rule, pred, mode)


def _cond_between(rule: Rule, ref, mode: str) -> Compiled:
    o = ref(rule.a)
    out = Compiled().add(f"NOT {o.p}", NOT_FOUND)
    if mode == OBSERVED:  # the reference compares text: "10" lies between "1" and "5"
        lo, hi = sql_str(str(rule.a_value_1)), sql_str(str(rule.a_value_2))
        return _finish(out, rule, f"({lo} <= {o.t} AND {o.t} <= {hi})", mode)
    lo, hi = py_float(rule.a_value_1), py_float(rule.a_value_2)
    out.add(f"{o.n} IS NULL", NOT_FOUND)
    if lo is None or hi is None:
        return out.add("TRUE", NOT_FOUND)
    pred = f"({num_cmp(o.n, 'greater_than_equal', lo)} AND {num_cmp(o.n, 'less_than_equal', hi)})"
    return _finish(out, rule, pred, mode)


def _cond_is_null(rule: Rule, ref, mode: str) -> Compiled:
    o = ref(rule.a)
    pred = f"({o.r} IS NULL OR {o.r} = '')" if mode == INTENDED else "FALSE"
    return _finish(Compiled().add(f"NOT {o.p}", NOT_FOUND), rule, pred, mode)


def _cond_equal_string(rule: Rule, ref, mode: str) -> Compiled:
    o = ref(rule.a)
    same = f"{o.r} <=> {sql_str(rule.a_value_1)}"
    # a number or a list is no string, whatever its text; null equals null only
    pred = f"({same})" if o.is_text == "TRUE" or rule.a_value_1 is None else f"({same} AND {o.is_text})"
    return _finish(Compiled().add(f"NOT {o.p}", NOT_FOUND), rule, pred, mode)


# ------------------------------------------------------------------ two+ keys

def _terms(ops: str, style: str, lit_style: str | None = None) -> list[Term]:
    out = []
    for op in ops.split(","):
        if op in ("is_null",):
            out.append(Term(op, "none", "none"))
        elif op == "is_in":
            out.append(Term(op, style, "none"))
        else:
            out.append(Term(op, style, lit_style or style))
    return out


def _multi(detail: str, style: str, **kw) -> Callable:
    def build(rule: Rule, ref, mode: str) -> Compiled:
        return conjunction(rule, ref, _terms(detail, style), mode, **kw)

    return build


def _super_bug(detail: str) -> Callable:
    """Rules whose fourth check is ``super(x).isfloat()``: it always raises.

    Observed: after ``a``, ``A`` and ``b`` read as numbers, outcome 9.
    Intended: the comparison named by the rule.
    """

    def build(rule: Rule, ref, mode: str) -> Compiled:
        terms = _terms(detail, "raw")
        return conjunction(rule, ref, terms, mode, trailing_error=True)

    return build


# Fixed values: (action, detail) pairs the reference accepts, and their rule.
PREDICATES: dict[tuple[str, str], Callable] = {}
for _action in CONDITIONAL_ACTIONS:
    PREDICATES.update({
        (_action, "equal"): _cond_numeric("equal"),
        (_action, "greater_than"): _cond_numeric("greater_than"),
        (_action, "greater_than_equal"): _cond_numeric("greater_than_equal"),
        (_action, "less_than"): _cond_numeric("less_than"),
        (_action, "less_than_equal"): _cond_numeric("less_than_equal"),
        (_action, "is_in"): _cond_is_in,
        (_action, "between_including"): _cond_between,
        (_action, "is_null"): _cond_is_null,
        (_action, "equal_string"): _cond_equal_string,
    })

_eq_eq = _multi("equal,equal", "str")
_eq_gt = _multi("equal,greater_than", "str")
_eq_null_empty = _multi("equal,is_null", "str", null_test="empty_text")
_lt_eq = _multi("less_than,equal", "str")
_gte_gt = _multi("greater_than_equal,greater_than", "raw", observed_ops=["equal", "greater_than"])

PREDICATES.update({
    ("multi_conditional", "equal,equal"): _eq_eq,
    ("multi_conditional", "equal,greater_than"): _eq_gt,
    ("multi_conditional", "equal,is_null"): _eq_null_empty,
    ("multi_conditional_and", "equal,equal"): _eq_eq,
    ("multi_conditional_and", "equal,is_null"): _multi("equal,is_null", "str", null_test="never"),
    ("multi_conditional_and", "less_than,equal"): _lt_eq,
    ("multi_conditional_and", "is_in,equal,equal"): _multi("is_in,equal,equal", "float"),
    ("multi_conditional_and", "equal,greater_than"): _super_bug("equal,greater_than"),
    ("multi_conditional_and", "is_in,equal"): _multi("is_in,equal", "float"),
    ("multi_conditional_and", "is_in,is_in"): _multi("is_in,is_in", "float"),
    ("multi_conditional_and", "greater_than_equal,greater_than"): _gte_gt,
    ("multi_conditional_and_2", "less_than,equal"): _lt_eq,
    ("multi_conditional_and_2", "equal,equal,equal,equal"): _multi("equal,equal,equal,equal", "float"),
    ("multi_conditional_and_2", "greater_than_equal,greater_than"): _gte_gt,
    ("multi_conditional_and_2", "equal,less_than,less_than"): _multi("equal,less_than,less_than", "raw"),
    ("multi_conditional_and_3", "equal,equal"): _eq_eq,
    ("multi_conditional_and_3", "equal,greater_than"): _eq_gt,
    ("multi_conditional_and_3", "equal,greater_than_equal"): _super_bug("equal,greater_than_equal"),
    ("multi_conditional_and_3", "equal,less_than"): _super_bug("equal,less_than"),
    ("multi_conditional_and_3", "equal,is_null"): _eq_null_empty,
    ("multi_conditional_and_3", "less_than,greater_than_equal"): _super_bug("less_than,greater_than_equal"),
    ("multi_conditional_and_3", "less_than,less_than"): _super_bug("less_than,less_than"),
    ("multi_conditional_and_3", "equal,equal,equal"): _multi("equal,equal,equal", "raw"),
    ("multi_conditional_and_3", "less_than,equal"): _lt_eq,
})
