"""Aligned long form, the filter barrier, rules of one's own, the packed trace."""

import pytest

from varloom import derive, long_form, rule
from varloom.operators.common import NOT_FOUND, RESOLVED, Compiled, TextVal
from varloom.plans.catalog import CHAIN_20

ROWS = [("r1", {"a": "5", "b": "x"}, {"a": "A", "c": "C"}), ("r2", {}, {"c": None}), ("r3", None, None), ("r4", {"a": None}, None)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "response_id string, values map<string,string>, labels map<string,string>")


def explained(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_long_form_unites_the_keys_of_all_maps(rows):
    out = long_form(rows, ["values", "labels"])
    assert out.columns == ["response_id", "key", "values", "labels"]
    want = set()
    for rid, *maps in ROWS:
        for k in {k for m in maps if m for k in m}:
            want.add((rid, k, *((m or {}).get(k) for m in maps)))
    got = [tuple(r) for r in out.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="another name"):
        long_form(rows.withColumnRenamed("response_id", "key"), ["values"])
    assert long_form(rows.withColumnRenamed("response_id", "key"), ["values"], key="question").columns == ["key", "labels", "question", "values"]


def test_derived_answers_beside_another_map(rows):
    out = derive(rows, [rule("v", 0, None, a="a")], output="long", align=["labels"])
    got = {(r.response_id, r.key): (r.value, r.labels) for r in out.collect()}
    assert got == {("r1", "a"): ("5", "A"), ("r1", "b"): ("x", None), ("r1", "c"): (None, "C"), ("r1", "v"): ("5", None),
                   ("r2", "c"): (None, None), ("r4", "a"): (None, None), ("r4", "v"): ("None", None)}
    with pytest.raises(ValueError, match="align"):
        derive(rows, [], output="wide", align=["labels"])


@pytest.mark.parametrize("depth", [20, 40])
def test_a_filter_at_the_end_of_a_chain_adds_one_node(spark, depth):
    chain = [rule("c0", 0, "product", a="q", A="1"), *(rule(f"c{i}", 0, "product", a=f"c{i - 1}", A="1") for i in range(1, depth))]
    df = spark.createDataFrame([(str(i), {"q": str(i)}, i) for i in range(5)], "response_id string, values map<string,string>, unused int")
    out = derive(df, chain, output="wide", barrier=True)
    last = f"c{depth - 1}"
    picked = out.filter(f"{last} = '3.0'").select("response_id", last)
    assert [tuple(r) for r in picked.collect()] == [("3", "3.0")]
    plain, filtered = explained(out.select("response_id", last)), explained(picked)
    assert len(filtered) < len(plain) + 2_000
    assert filtered.index("Filter") < filtered.index("CollectMetrics") and filtered.count("unused") == 1  # the leaf itself


def test_barriers_of_two_results_do_not_meet(rows):
    one, two = (derive(rows, [rule("v", 0, None, a="a")], output="wide", barrier=True).select("response_id", "v") for _ in range(2))
    assert one.unionByName(two).filter("v = '5'").count() == 2


def test_rules_of_ones_own(rows):
    def shout(r, ref, mode):
        o = ref(r.a)
        out = Compiled().add(f"NOT {o.p}", NOT_FOUND).add("TRUE", RESOLVED)
        out.vals[RESOLVED] = TextVal(f"concat(upper({o.t}), '!')")
        return out

    rules = [rule("v", 0, "shout", a="b"), rule("w", 1, "merge", a="v", b="a")]
    with pytest.raises(ValueError, match="unsupported"):
        derive(rows, rules)
    got = {r.response_id: (r.v, r.w) for r in derive(rows, rules, output="wide", builders={("shout", None): shout}).collect()}
    assert got["r1"] == ("X!", "X!5") and got["r2"] == (None, None)
    # one detail only, before a built-in rule of the same name; nothing is kept for the next call
    got = derive(rows, [rule("v", 0, "merge", "loud", a="b", b="a"), rule("u", 0, "merge", a="b", b="a")], output="wide", builders={("merge", "loud"): shout})
    assert [(r.v, r.u) for r in got.filter("response_id = 'r1'").collect()] == [("X!", "x5")]
    with pytest.raises(ValueError, match="unsupported"):
        derive(rows, rules)


def test_trace_of_blocks_with_many_rules_and_passes(spark):
    rules = [rule("v", p, "conditional", "equal", a="q", A=str(i), then=f"{p}") for p in range(3) for i in range(0, 20, p + 1)]
    df = spark.createDataFrame([(str(i), {"q": str(i)} if i % 7 else {}) for i in range(60)], "response_id string, values map<string,string>")
    want = {}
    for i in range(60):
        gone = False
        for p in range(3):
            for n, r in enumerate(rules):
                if r["pass_number"] != p or gone:
                    continue
                outcome = 3 if not i % 7 else 1 if r["survey_id_a_value_1"] == str(i) else 2
                want[(p, n, outcome)] = want.get((p, n, outcome), 0) + 1
                gone = outcome == 3
                if outcome != 2:
                    break
    got = {(r.pass_number, r.rule_no, r.outcome): r.n for r in derive(df, rules, output="trace").collect()}
    assert got == want


def test_the_plan_of_a_trace_grows_with_the_rules_only(spark):
    df = spark.createDataFrame([("1", {"q": "1"})], "response_id string, values map<string,string>")

    def width(n):
        out = derive(df, [rule(f"v{i}", 0, "conditional", "equal", a="q", A=str(i), then="y") for i in range(n)], output="trace")
        return out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    assert width(5) == width(100) == 2
