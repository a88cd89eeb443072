"""The hand-traced example of SURVEY §2.2 (first golden test)."""

import pytest

from varloom import derive, rule

RULES = [
    rule("v1", 0, "conditional", "equal", a="q1", A="3", then="hi"),
    rule("v1", 0, "conditional", "greater_than", a="q1", A="1", then="big"),
    rule("v2", 0, "conditional", "equal", a="q9", A="1", then="x"),
    rule("v3", 0, "merge", a="q1", b="v1"),
    rule("v1", 1, "conditional", "less_than", a="q1", A="5", then="low"),
    rule("v2", 1, None, a="q1"),
    rule("v3", 1, "conditional", "equal", a="q1", A="9", then="z"),
    rule("v4", 1, None, a="v1"),
]


@pytest.mark.parametrize("mode", ["intended", "observed"])
def test_worked_example(spark, mode):
    df = spark.createDataFrame([("r1", {"q1": "3", "q2": ""})], "response_id string, values map<string,string>")
    out = derive(df, RULES, mode=mode).first()
    assert out.values == {"q1": "3", "q2": "", "v1": "low", "v3": "3hi", "v4": "low"}
    codes = derive(df, RULES, mode=mode, output="outcomes").first().asDict()
    assert codes == {"response_id": "r1", "v1__p0": 1, "v2__p0": 3, "v3__p0": 1, "v1__p1": 1,
                     "v2__p1": 0, "v3__p1": 2, "v4__p1": 1}


def test_unsupported_rule_fails_at_compile_time(spark):
    from varloom.operators.common import UnsupportedRule
    from varloom.plans.compiler import compile_rules

    with pytest.raises(UnsupportedRule):
        compile_rules([rule("v", 0, "conditional", "approximately", a="q", A="1")])
    with pytest.raises(UnsupportedRule):
        compile_rules([rule("v", 0, "teleport", a="q")])
