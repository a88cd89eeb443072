"""Many rule sets in one chain: rows equal each survey's own derivation, columns are shared."""

import random

import pytest
from test_model import POOL, random_rule

from varloom import derive, rule
from varloom.plans.all_surveys import derive_all_surveys
from varloom.plans.compiler import compile_rules
from varloom.plans.router import Router
from varloom.plans.rules import rules_dataframe


def rule_table(spark, by_survey):
    rows = [(s, r) for s, rules in by_survey.items() for r in rules]
    ids = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "rule_no int, survey_id string")
    return rules_dataframe(spark, [r for _, r in rows]).join(ids, "rule_no")


@pytest.mark.parametrize("seed", range(4))
def test_rows_equal_each_surveys_own_derivation(spark, seed):
    rng = random.Random(seed)
    by_survey = {f"SV '{i}`": [random_rule(rng, rng.choice(["v1", "v2", "v3"]), rng.randrange(3)) for _ in range(rng.randint(1, 8))] for i in range(7)}
    by_survey["same"] = by_survey["SV '0`"]
    rows = [(f"{s}/{i}", s, {k: rng.choice(POOL) for k in ["q1", "q2", "q3", "v2"] if rng.random() < 0.85})
            for s in [*by_survey, "without rules"] for i in range(15)]
    responses = spark.createDataFrame(rows, "response_id string, survey_id string, values map<string,string>")
    got = {r.response_id: r["values"] for r in derive_all_surveys(responses, rule_table(spark, by_survey), output="map").collect()}
    wide = {r.response_id: r.asDict() for r in derive_all_surveys(responses, rule_table(spark, by_survey)).collect()}
    assert len(got) == len(wide) == 15 * len(by_survey)
    for survey, rules in by_survey.items():
        for r in derive(responses.filter(responses.survey_id == survey), rules).collect():
            assert got[r.response_id] == r["values"], (rules, r)
            for v in {x["new_variable"] for x in rules}:
                assert wide[r.response_id][v] == r["values"].get(v)


def test_rule_sets_that_differ_in_literals_share_every_expression(spark):
    def plan(i):
        return compile_rules([rule("v", 0, "conditional", "greater_than", a=f"q{i}", A=str(i), then=f"it's {i}", otherwise=None),
                              rule("w", 1, "sum", a=f"q{i},k{i}"), rule("x", 1, None, a="v")])

    few, many = (Router([plan(i) for i in range(n)]) for n in (2, 50))
    assert [len(x) for x in few.layers] == [len(x) for x in many.layers] == [len(x) for x in plan(0).layers]
    assert all("CASE WHEN array(" not in sql for layer in many.layers for _, sql in layer)


def test_rule_sets_of_different_shapes_need_no_more_columns_than_the_widest():
    one = compile_rules([rule("v", 0, None, a="q")])
    other = compile_rules([rule(f"v{i}", 0, "mean", a="q,r") for i in range(5)])
    alone, together = Router([other]), Router([one, other, one])
    assert sum(map(len, together.layers)) <= sum(map(len, alone.layers)) + 3


def test_rules_of_ones_own_are_routed(spark):
    from varloom.operators.common import RESOLVED, Compiled, TextVal

    def shout(r, ref, mode):
        out = Compiled().add("TRUE", RESOLVED)
        out.vals[RESOLVED] = TextVal(f"upper({ref(r.a).t})")
        return out

    responses = spark.createDataFrame([("r1", "s1", {"a": "x"}), ("r2", "s2", {"b": "y"}), ("r3", None, {"a": "z"})],
                                      "response_id string, survey_id string, values map<string,string>")
    rules = rule_table(spark, {"s1": [rule("v", 0, "shout", a="a")], "s2": [rule("v", 0, "shout", a="b")]})
    with pytest.raises(ValueError, match="unsupported"):
        derive_all_surveys(responses, rules)
    out = derive_all_surveys(responses, rules, builders={("shout", None): shout})
    assert {r.response_id: r.v for r in out.collect()} == {"r1": "X", "r2": "Y"}
