"""Value rules (V1-V12): recode, arithmetic, horizontal sums and means, text.

These always resolve the variable (outcome 1) unless a key is absent (3) or
the reference would raise on the data (9). "Horizontal" aggregates work
inside one response, across the keys a rule names, with array functions.
"""

from __future__ import annotations

from collections.abc import Callable

from varloom.functions.values import exact_mean, is_digits, py_float, py_int, sql_double
from varloom.operators.common import (
    ERROR,
    INTENDED,
    NOT_FOUND,
    OBSERVED,
    RESOLVED,
    RESOLVED_ALT,
    RESOLVED_ELSE,
    Compiled,
    LitVal,
    NumVal,
    TextVal,
    any_absent,
)
from varloom.plans.rules import Rule


def key_list(rule: Rule) -> list[str]:
    """``survey_id_a`` split on commas, not trimmed (V13)."""
    if rule.a is None:
        raise ValueError(f"rule {rule.rule_no}: {rule.action} needs survey_id_a")
    return rule.a.split(",")


def _recode(base_observed: int, base_intended: int) -> Callable:
    def build(rule: Rule, ref, mode: str) -> Compiled:
        o = ref(rule.a)
        base = base_observed if mode == OBSERVED else base_intended
        out = Compiled().add(f"NOT {o.p}", NOT_FOUND)
        digits = f"try_cast({o.t} AS BIGINT)"
        # isnumeric() fails: the reference's result is unbound (raises)
        out.add(f"NOT {is_digits(o.t)} OR {digits} IS NULL", ERROR)
        out.add("TRUE", RESOLVED)
        out.vals[RESOLVED] = NumVal(f"CAST({base} - {digits} AS DOUBLE)", "int")
        return out

    return build


def _subtraction(rule: Rule, ref, mode: str) -> Compiled:
    a, b = ref(rule.a), ref(rule.b)
    out = Compiled().add(any_absent([a, b]), NOT_FOUND)
    out.add(f"{a.n} IS NULL OR {b.n} IS NULL", ERROR)
    out.add("TRUE", RESOLVED)
    out.vals[RESOLVED] = NumVal(f"({a.n} - {b.n})")
    return out


def _sum(rule: Rule, ref, mode: str) -> Compiled:
    keys = list(dict.fromkeys(key_list(rule)))  # distinct keys, absent ones skipped
    bad, count, total = zip(*(ref(k).listed for k in keys), strict=True)
    out = Compiled().add(" OR ".join(bad), ERROR)
    out.add(f"({' + '.join(count)}) = 0", RESOLVED_ELSE)
    out.vals[RESOLVED_ELSE] = LitVal("")
    out.add("TRUE", RESOLVED)
    out.vals[RESOLVED] = NumVal("(" + " + ".join(total) + ")", own_layer=len(keys) > 1)
    return out


def _mean(rule: Rule, ref, mode: str) -> Compiled:
    ops = [ref(k) for k in key_list(rule)]  # duplicates count twice
    out = Compiled().add(any_absent(ops), NOT_FOUND)
    out.add(" OR ".join(f"{o.n} IS NULL" for o in ops), ERROR)
    out.add("TRUE", RESOLVED)
    out.vals[RESOLVED] = NumVal(exact_mean([o.n for o in ops]), own_layer=True)
    return out


def _mean_n_or_more(n_missing: int) -> Callable:
    """Mean of the answers given; ``""`` once ``n_missing`` or more are missing."""

    def build(rule: Rule, ref, mode: str) -> Compiled:
        ops = [ref(k) for k in key_list(rule)]
        if mode == OBSERVED:
            given = [f"({o.p} AND {o.r} IS NOT NULL)" for o in ops]
            nums = [py_int(o.r) for o in ops]
        else:
            given = [f"({o.p} AND {o.r} IS NOT NULL AND {o.r} <> '')" for o in ops]
            nums = [o.n for o in ops]
        count = " + ".join(f"CASE WHEN {g} THEN 1 ELSE 0 END" for g in given)
        bad = " OR ".join(f"({g} AND {x} IS NULL)" for g, x in zip(given, nums))
        out = Compiled().add(bad, ERROR)
        out.add(f"{len(ops)} - ({count}) >= {n_missing}", RESOLVED_ELSE)
        out.vals[RESOLVED_ELSE] = LitVal("")
        # nothing given and fewer missing than N: mean of nothing raises in the reference
        out.add(f"({count}) = 0", ERROR if mode == OBSERVED else RESOLVED_ELSE)
        mean = exact_mean([f"CASE WHEN {g} THEN {x} END" for g, x in zip(given, nums)])
        if mode == OBSERVED:
            out.add("TRUE", RESOLVED_ALT)
        else:
            ints = " AND ".join(f"(NOT {g} OR (translate({o.r}, '0123456789+- ', '') = '' "
                                f"AND try_cast(trim({o.r}) AS BIGINT) IS NOT NULL))" for g, o in zip(given, ops))
            out.add(ints, RESOLVED_ALT)
            out.add("TRUE", RESOLVED)
            out.vals[RESOLVED] = NumVal(mean, own_layer=True)
        out.vals[RESOLVED_ALT] = NumVal(mean, "mean", own_layer=True)
        return out

    return build


def _mean_skipna(rule: Rule, ref, mode: str) -> Compiled:
    ops = [ref(k) for k in key_list(rule)]
    out = Compiled()
    kept = []
    for o in ops:  # keys are read in order: the first absent or non-numeric decides
        out.add(f"NOT {o.p}", NOT_FOUND)
        if mode == OBSERVED:
            out.add(f"NOT {is_digits(o.t)}", RESOLVED_ELSE)
            kept.append((f"{o.n}", "TRUE"))
        else:
            skip = f"({o.n} IS NOT NULL AND {o.n} = -99)"
            out.add(f"{o.n} IS NULL", RESOLVED_ELSE)
            kept.append((o.n, f"NOT {skip}"))
    out.vals[RESOLVED_ELSE] = LitVal("")
    count = " + ".join(f"CASE WHEN {k} THEN 1 ELSE 0 END" for _, k in kept)
    out.add(f"({count}) = 0", RESOLVED_ELSE)
    out.add("TRUE", RESOLVED)
    out.vals[RESOLVED] = NumVal(exact_mean([f"CASE WHEN {k} THEN {x} END" for x, k in kept]), own_layer=True)
    return out


def _merge(rule: Rule, ref, mode: str) -> Compiled:
    a, b = ref(rule.a), ref(rule.b)
    out = Compiled().add(any_absent([a, b]), NOT_FOUND).add("TRUE", RESOLVED)
    out.vals[RESOLVED] = TextVal(f"concat({a.t}, {b.t})")
    return out


def _product(rule: Rule, ref, mode: str) -> Compiled:
    a = ref(rule.a)
    factor = py_float(rule.a_value_1)
    out = Compiled().add(f"NOT {a.p}", NOT_FOUND)
    if factor is None:
        out.add("TRUE", RESOLVED_ELSE)
    else:
        out.add(f"{a.n} IS NULL", RESOLVED_ELSE)
        out.add("TRUE", RESOLVED)
        out.vals[RESOLVED] = NumVal(f"({a.n} * {sql_double(factor)})")
    out.vals[RESOLVED_ELSE] = LitVal("")
    return out


def _copy(rule: Rule, ref, mode: str) -> Compiled:
    a = ref(rule.a)
    out = Compiled().add(f"NOT {a.p}", NOT_FOUND).add("TRUE", RESOLVED)
    out.vals[RESOLVED] = TextVal(a.t)
    return out


def _count(rule: Rule, ref, mode: str) -> Compiled:
    a = ref(rule.a)
    parts = f"size(split({a.t}, ',', -1))"
    if mode == INTENDED:
        empty = f"({a.r} IS NULL OR {a.r} = '' OR regexp_replace({a.r}, '\\\\s', '') = '[]')"
        parts = f"CASE WHEN {empty} THEN 0 ELSE {parts} END"
    out = Compiled().add(f"NOT {a.p}", NOT_FOUND).add("TRUE", RESOLVED)
    out.vals[RESOLVED] = NumVal(f"CAST({parts} AS DOUBLE)", "int")
    return out


# Value actions the reference accepts (None = copy).
VALUE_FUNCTIONS: dict[str | None, Callable] = {
    "recode": _recode(6, 6),
    "recode_2": _recode(6, 8),
    "recode_3": _recode(6, 6),
    "subtraction": _subtraction,
    "sum": _sum,
    "sum_2": _sum,
    "sum_3": _sum,
    "sum_4": _sum,
    "mean": _mean,
    "mean_2_or_more": _mean_n_or_more(2),
    "mean_3_or_more": _mean_n_or_more(3),
    "mean_4_or_more": _mean_n_or_more(4),
    "mean_5_or_more": _mean_n_or_more(5),
    "mean_skipna": _mean_skipna,
    "merge": _merge,
    "product": _product,
    None: _copy,
    "count": _count,
}
