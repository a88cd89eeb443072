"""Every kind of rule in both modes against a plain-Python reading of SURVEY §2.3 and §2.4, over raw answers."""

import math
import random
import re
import statistics

import pytest
from test_model import cmp, num

from varloom import derive, rule

#: action, detail, how operands are read, what null means in observed mode, a last literal that observed mode stumbles over
CONJUNCTIONS = [
    ("multi_conditional", "equal,equal", "str", None, False), ("multi_conditional_and_3", "equal,equal", "str", None, False),
    ("multi_conditional", "equal,greater_than", "str", None, False), ("multi_conditional_and_3", "equal,greater_than", "str", None, False),
    ("multi_conditional", "equal,is_null", "str", "empty", False), ("multi_conditional_and_3", "equal,is_null", "str", "empty", False),
    ("multi_conditional_and", "equal,equal", "str", None, False), ("multi_conditional_and", "equal,is_null", "str", "never", False),
    ("multi_conditional_and", "less_than,equal", "str", None, False), ("multi_conditional_and_2", "less_than,equal", "str", None, False),
    ("multi_conditional_and_3", "less_than,equal", "str", None, False), ("multi_conditional_and", "is_in,equal,equal", "float", None, False),
    ("multi_conditional_and", "equal,greater_than", "raw", None, True), ("multi_conditional_and", "is_in,equal", "float", None, False),
    ("multi_conditional_and", "is_in,is_in", "float", None, False), ("multi_conditional_and", "greater_than_equal,greater_than", "raw", None, False),
    ("multi_conditional_and_2", "greater_than_equal,greater_than", "raw", None, False),
    ("multi_conditional_and_2", "equal,equal,equal,equal", "float", None, False), ("multi_conditional_and_2", "equal,less_than,less_than", "raw", None, False),
    ("multi_conditional_and_3", "equal,greater_than_equal", "raw", None, True), ("multi_conditional_and_3", "equal,less_than", "raw", None, True),
    ("multi_conditional_and_3", "less_than,greater_than_equal", "raw", None, True), ("multi_conditional_and_3", "less_than,less_than", "raw", None, True),
    ("multi_conditional_and_3", "equal,equal,equal", "raw", None, False),
]
VALUES = ["recode", "recode_2", "recode_3", "subtraction", "mean", "mean_2_or_more", "mean_3_or_more", "mean_4_or_more", "mean_5_or_more",
          "mean_skipna", "merge", "product", "count", None]
KEYS = ["q1", "q2", "q3", "q4", "q5", "q6"]
POOL = ["1", "2", "3", "4", "2.5", "0.1", "0.2", "0", "-1", "-99", "", "abc", None, " 2 ", "1e3", "nan", "10", "1,2", "[]"]
LITS = ["1", "2", "3", "2.5", "0", "abc", None, "", "1,2,3", "nan"]


def unread(x, style):
    """The outcome of an operand that is no number, else None."""
    if x is None:
        return 3 if style == "str" else 9
    return None if num(x) is not None else 9 if style == "float" else 3


def decide(r, met, mode):
    if met:
        return 1, r["fill_with_this"]
    e = r["else"]
    usable = e is not None and (num(e) is None if mode == "observed" else not (num(e) is not None and math.isnan(num(e))))
    return (1, e) if usable else (2, None)


def conjunction(r, vals, mode, style, null, stumbles):
    ops = r["detail"].split(",")
    keys = [r[f"survey_id_{x}"] for x in "abcd"[:len(ops)]]
    lits = [r["survey_id_a_value_1"], r["survey_id_b_value"], r["survey_id_c_value"], r["survey_id_d_value"]]
    if any(k not in vals for k in keys):
        return 3, None
    stumbles = stumbles and mode == "observed"
    for i, op in enumerate(ops):
        if op != "is_null" and (code := unread(vals[keys[i]], style)):
            return code, None
        if op not in ("is_null", "is_in") and not (stumbles and i == len(ops) - 1) and (code := unread(lits[i], style)):
            return code, None
    if stumbles:
        return 9, None
    if mode == "observed" and r["detail"] == "greater_than_equal,greater_than":
        ops = ["equal", "greater_than"]
    met = []
    for op, k, lit in zip(ops, keys, lits):
        x = vals[k]
        if op == "is_null":
            met.append(x is None or x == "" if mode == "intended" else null == "empty" and x == "")
        elif op == "is_in":
            met.append(mode == "intended" and any(cmp("equal", num(x), n) for n in map(num, str(lit).split(",")) if n is not None))
        else:
            met.append(cmp(op, num(x), num(lit)))
    return decide(r, all(met), mode)


def single(r, vals, mode):
    a, lit, lit2 = r["survey_id_a"], r["survey_id_a_value_1"], r["survey_id_a_value_2"]
    if a not in vals:
        return 3, None
    x, t = vals[a], str(vals[a])
    if r["detail"] == "between_including":
        if mode == "observed":
            return decide(r, str(lit) <= t <= str(lit2), mode)
        if None in (num(x), num(lit), num(lit2)):
            return 3, None
        return decide(r, num(lit) <= num(x) <= num(lit2), mode)
    if r["detail"] == "is_null":
        return decide(r, mode == "intended" and (x is None or x == ""), mode)
    if r["detail"] == "is_in":
        return decide(r, t in str(lit).split(","), mode)
    if r["detail"] == "equal_string":
        return decide(r, x == lit, mode)
    return (3, None) if num(x) is None or num(lit) is None else decide(r, cmp(r["detail"], num(x), num(lit)), mode)


def mean_or_more(keys, vals, mode, n):
    given = [vals[k] for k in keys if vals.get(k) is not None and (mode == "observed" or vals[k] != "")]
    try:
        if mode == "observed" or all(re.fullmatch(r"\s*[+-]?[0-9]+\s*", x) for x in given):
            xs = [int(x) for x in given]
        else:
            xs = [float(x) for x in given]
    except ValueError:
        return 9, None
    if len(keys) - len(xs) >= n:
        return 1, ""
    if not xs:
        return (9, None) if mode == "observed" else (1, "")
    return 1, str(statistics.mean(xs))


def value(r, vals, mode):
    act, keys, b = r["action"], r["survey_id_a"].split(","), r["survey_id_b"]
    if act and act.endswith("_or_more"):
        return mean_or_more(keys, vals, mode, int(act.split("_")[1]))
    if act == "mean_skipna":
        xs = []
        for k in keys:
            if k not in vals:
                return 3, None
            if not str(vals[k]).isnumeric() if mode == "observed" else num(vals[k]) is None:
                return 1, ""
            if mode == "observed" or num(vals[k]) != -99:
                xs.append(float(vals[k]))
        return 1, repr(statistics.mean(xs)) if xs else ""
    if any(k not in vals for k in keys + ([b] if act in ("subtraction", "merge") else [])):
        return 3, None
    x, t = vals[keys[0]], str(vals[keys[0]])
    if act == "mean":
        xs = [num(vals[k]) for k in keys]
        return (9, None) if None in xs else (1, repr(statistics.mean(xs)))
    if act == "subtraction":
        return (9, None) if None in (num(x), num(vals[b])) else (1, repr(num(x) - num(vals[b])))
    if act == "merge":
        return 1, t + str(vals[b])
    if act == "product":
        n, f = num(x), num(str(r["survey_id_a_value_1"]))
        return 1, "" if n is None or f is None else repr(n * f)
    if act == "count":
        return 1, "0" if mode == "intended" and t in ("None", "", "[]") else str(len(t.split(",")))
    if act is None:
        return 1, t
    return (1, str((8 if act == "recode_2" and mode == "intended" else 6) - int(t))) if t.isnumeric() else (9, None)


def rules_and_models(rng):
    out = []
    for action, detail, *how in CONJUNCTIONS:
        a, b, c, d = rng.sample(KEYS[:4], 4)
        lits = [rng.choice(LITS if rng.random() < 0.3 else ["1", "2", "1,2,3", "2.5"]) for _ in range(4)]
        n = len(detail.split(","))
        out.append((dict(action=action, detail=detail, a=a, A=lits[0], b=b, B=lits[1], c=c if n > 2 else None, C=lits[2], d=d if n > 3 else None, D=lits[3]),
                    lambda r, vals, mode, how=how: conjunction(r, vals, mode, *how)))
    for detail in ("equal", "greater_than", "greater_than_equal", "less_than", "less_than_equal", "is_in", "between_including", "is_null", "equal_string"):
        for action in ("conditional", "conditional_2", "conditional_3"):
            out.append((dict(action=action, detail=detail, a=rng.choice(KEYS), A=rng.choice(LITS), A2=rng.choice(["3", "5", "10", "abc"])), single))
    for action in VALUES:
        for _ in range(2):
            several = action in VALUES[4:10]
            a = ",".join(rng.choices(KEYS, k=rng.randint(1, 6))) if several else rng.choice(KEYS)
            out.append((dict(action=action, a=a, b=rng.choice(KEYS), A=rng.choice(LITS)), value))
    return [(rule(f"v{i}", 0, then=rng.choice(["x", "y"]), otherwise=rng.choice([None, "z", "", "5", "nan"]), **r), m) for i, (r, m) in enumerate(out)]


@pytest.mark.parametrize("mode", ["intended", "observed"])
@pytest.mark.parametrize("seed", range(2))
def test_every_kind_of_rule(spark, mode, seed):
    rng = random.Random(seed)
    both = rules_and_models(rng)
    rules = [r for r, _ in both]
    simple = ["1", "2", "3", "2.5", "-99"]
    rows = [(str(i), {k: rng.choice(simple if i % 2 else POOL) for k in KEYS if rng.random() < (0.97 if i % 2 else 0.85)}) for i in range(500)]
    df = spark.createDataFrame(rows, "response_id string, values map<string,string>")
    codes = {r.response_id: r.asDict() for r in derive(df, rules, mode=mode, output="outcomes").collect()}
    wide = {r.response_id: r.asDict() for r in derive(df, rules, mode=mode, output="wide").collect()}
    wrong = []
    for rid, vals in rows:
        for r, m in both:
            want = m(r, vals, mode)
            got = codes[rid][f"{r['new_variable']}__p0"], wide[rid][r["new_variable"]]
            if got != want:
                wrong.append(({k: v for k, v in r.items() if v is not None}, vals, got, want))
    kinds = sorted({(w[0].get("action"), w[0].get("detail")) for w in wrong}, key=str)
    assert not wrong, (len(wrong), kinds, wrong[:3])
