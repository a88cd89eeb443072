"""Rule tables, errors, plan sizes and the all-surveys job."""

import math
import statistics

import pandas as pd
import pytest

from varloom import derive, rule
from varloom.plans.all_surveys import compile_groups, derive_all_surveys
from varloom.plans.catalog import CHAIN_20, QUERIES
from varloom.plans.compiler import compile_rules
from varloom.plans.rules import load_rules, rules_dataframe

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def responses(spark):
    rows = [("r1", "SV_1", {"a": "5", "b": "x"}), ("r2", "SV_2", {"a": "7"}), ("r3", "SV_3", {"a": "no"})]
    return spark.createDataFrame(rows, "response_id string, survey_id string, values map<string,string>")


@pytest.mark.parametrize("mode", ["intended", "observed"])
def test_nan_literal_compares_false_and_the_next_rule_is_tried(responses, mode):
    rows = [rule("v", 0, "conditional", "equal", a="a", A="5", then="first"), rule("v", 0, "conditional", "equal", a="a", A="7", then="second")]
    table = pd.DataFrame(rows)
    table.loc[0, "survey_id_a_value_1"] = math.nan
    got = {r.response_id: r.v for r in derive(responses, table, mode=mode, output="wide").collect()}
    assert got["r2"] == "second" and got["r1"] is None


def test_blank_action_is_not_copy(responses):
    table = pd.DataFrame([rule("v", 0, None, a="a")])
    assert derive(responses, table, output="wide").filter("v is not null").count() == 3
    table["action"] = math.nan
    with pytest.raises(ValueError, match="unsupported"):
        derive(responses, table)


def test_spark_rule_tables_need_an_order(spark, responses):
    rules = rules_dataframe(spark, [rule("v", 0, None, a="a")])
    assert derive(responses, rules, output="wide").count() == 3
    with pytest.raises(ValueError, match="rule_no"):
        derive(responses, rules.drop("rule_no"))


def test_no_cap_on_rules():
    rows = [rule(f"v{i}", 0, "conditional", "equal", a="a", A=str(i), then="y") for i in range(5001)]
    assert len(compile_rules(rows).blocks) == 5001
    with pytest.raises(ValueError, match="more than 10"):
        load_rules(rows, max_rules=10)
    per_survey = {f"SV_{i}": rows[50 * i % 4000:50 * i % 4000 + 50] for i in range(101)}
    groups = compile_groups(per_survey, "intended", None)
    assert sum(len(ids) for ids, _ in groups) == 101 and len(groups) == 80


@pytest.mark.parametrize("mode", ["intended", "observed"])
def test_errors_are_raised_only_where_a_response_gets_to_them(responses, mode):
    rules = [rule("v", 0, "conditional", "equal", a="a", A="5", then="five"), rule("v", 0, "no such action", a="a")]
    with pytest.raises(ValueError, match="unsupported"):
        derive(responses, rules, mode=mode)
    first = responses.filter("response_id = 'r1'")
    assert [r.v for r in derive(first, rules, mode=mode, output="wide", on_error="fail").collect()] == ["five"]
    with pytest.raises(Exception, match="rule 1"):
        derive(responses, rules, mode=mode, output="wide", on_error="fail").collect()
    codes = {r.response_id: r.v__p0 for r in derive(responses, rules, mode=mode, output="outcomes", on_error="quarantine").collect()}
    assert codes["r1"] == 1 and codes["r2"] == 9


def test_sums_parse_each_key_once():
    plan = compile_rules([rule("t", 0, "sum", a=",".join(f"q{i}" for i in range(7))), rule("u", 0, "sum", a="q0,q1")])
    sql = [s for layer in plan.layers for _, s in layer]
    assert sum("transform(transform(split(" in s for s in sql) == 7
    assert sum(map(len, sql)) < 25_000 and max(map(len, sql)) < 2_000


def test_deep_chains_stay_in_generated_code(spark):
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        from varloom.sources import fixtures as fx

        out = derive(fx.lineitem_responses(spark, SF0001), CHAIN_20, output="wide")
        rows = out.limit(50).collect()
        assert all(r.c19 == r.c0 for r in rows) and len(rows) == 50
        out.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_all_surveys_read_the_responses_once(spark, responses):
    rows = [(i, s, *(rule("v", 0, "conditional", "equal", a="a", A=str(5 + i), then=s).get(c) for c in ("new_variable", "pass_number", "action", "detail",
             "survey_id_a", "survey_id_a_value_1", "fill_with_this"))) for i, s in enumerate(["SV_1", "SV_2", "SV_3"])]
    rules = spark.createDataFrame(rows, "rule_no int, survey_id string, new_variable string, pass_number int, action string, detail string, "
                                        "survey_id_a string, survey_id_a_value_1 string, fill_with_this string")
    out = derive_all_surveys(responses, rules)
    assert {r.response_id: r.v for r in out.collect()} == {"r1": "SV_1", "r2": None, "r3": None}
    plan = QUERIES["all_surveys"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # orders and lineitem, once each


def test_one_bad_survey_does_not_stop_the_rest(spark, responses):
    rules = spark.createDataFrame([(0, "SV_1", "v", 0, None, "a"), (1, "SV_2", "v", 0, "no such action", "a")],
                                  "rule_no int, survey_id string, new_variable string, pass_number int, action string, survey_id_a string")
    failed = {}
    with pytest.warns(UserWarning, match="SV_2"):
        out = derive_all_surveys(responses, rules, failed=failed)
    assert {r.response_id: r.v for r in out.collect()} == {"r1": "5"} and list(failed) == ["SV_2"]
    with pytest.raises(ValueError):
        derive_all_surveys(responses, rules)


def test_trace_counts_every_evaluated_rule(responses):
    rules = [rule("v", 0, "conditional", "equal", a="a", A="5", then="x"), rule("v", 0, "conditional", "equal", a="a", A="7", then="y")]
    got = {(r.rule_no, r.outcome): r.n for r in derive(responses, rules, output="trace").collect()}
    assert got == {(0, 1): 1, (0, 2): 1, (0, 3): 1, (1, 1): 1}


def test_mean_functions(spark):
    cases = [({"a": "0.1", "b": "0.2", "c": "0.3"}, statistics.mean([0.1, 0.2, 0.3])), ({"a": "1", "b": "2", "c": "4"}, statistics.mean([1, 2, 4])),
             ({"a": "1.5", "b": "", "c": None}, ""), ({"a": "2.5", "b": "0.1", "c": ""}, statistics.mean([2.5, 0.1]))]
    df = spark.createDataFrame([(str(i), m) for i, (m, _) in enumerate(cases)], "response_id string, values map<string,string>")
    got = {r.response_id: r.v for r in derive(df, [rule("v", 0, "mean_2_or_more", a="a,b,c")], output="wide").collect()}
    assert [float(x) if x else x for x in (got[str(i)] for i in range(4))] == [w for _, w in cases]
    skip = spark.createDataFrame([("0", {"a": "-99", "b": "4", "c": "5"}), ("1", {"a": "-99", "b": "-99", "c": "-99"})], "response_id string, values map<string,string>")
    got = {r.response_id: r.v for r in derive(skip, [rule("v", 0, "mean_skipna", a="a,b,c")], output="wide").collect()}
    assert got == {"0": "4.5", "1": ""}


def test_sums_read_answers_as_literals(spark):
    answers = {"padded": "007", "hex": "[0x1F, True]", "zero": "-0.0", "nested": "[[1]]", "spaced": "- 3", "mixed": "['1.5', 0b11, 00]"}
    df = spark.createDataFrame([("r", answers)], "response_id string, values map<string,string>")
    rules = [rule(f"s_{k}", 0, "sum", a=k) for k in answers]
    got = derive(df, rules, output="wide").first().asDict()
    assert got == {"response_id": "r", "s_padded": None, "s_hex": "32.0", "s_zero": "0.0", "s_nested": None, "s_spaced": "-3.0", "s_mixed": "4.5"}
    codes = derive(df, rules, output="outcomes").first().asDict()
    assert codes["s_padded__p0"] == codes["s_nested__p0"] == 9
