"""Plan shape: derive is narrow (no Exchange, no Python) and prunes the scan."""

from varloom import derive, rule
from varloom.plans.catalog import FLAGSHIP_RULES

SF0001 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_derive_adds_no_shuffle_and_no_python(spark):
    src = spark.read.parquet(f"{SF0001}/lineitem.parquet").selectExpr(
        "CAST(l_orderkey AS STRING) AS response_id",
        "map('qty', CAST(l_quantity AS STRING), 'line', CAST(l_linenumber AS STRING)) AS `values`")
    out = derive(src, [rule("v", 0, "conditional", "greater_than", a="qty", A="25", then="y", otherwise="n"),
                       rule("w", 1, "merge", a="v", b="line")], output="wide")
    plan = _plan(out)
    assert "Exchange" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "l_quantity" in plan and "l_extendedprice" not in plan.split("ReadSchema")[-1]


def test_flagship_map_output_no_python(spark):
    from varloom.sources.fixtures import order_responses

    plan = _plan(derive(order_responses(spark, SF0001), FLAGSHIP_RULES))
    assert "Python" not in plan


def test_trace_shuffle_is_partial_aggregate(spark):
    from varloom.sources.fixtures import lineitem_responses

    out = derive(lineitem_responses(spark, SF0001),
                 [rule("v", 0, "conditional", "greater_than", a="qty", A="25", then="y")], output="trace")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
    rows = out.collect()
    assert sum(r.n for r in rows) == spark.read.parquet(f"{SF0001}/lineitem.parquet").count()
