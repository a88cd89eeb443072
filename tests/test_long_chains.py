"""Long chains: generated code stays small enough for the JVM to compile, texts of numbers whatever their size."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from varloom.operators.derive import derive
from varloom.plans.rules import rule


def chain(depth: int, factor: str) -> list[dict]:
    return [rule("c0", 0, "product", a="x", A=factor)] + [rule(f"c{i}", 0, "product", a=f"c{i - 1}", A=factor) for i in range(1, depth)]


def test_methods_of_a_long_chain_stay_below_the_limit_of_the_jvm(spark):
    rows = spark.range(4).selectExpr("CAST(id AS STRING) AS response_id", "map('x', CAST(id AS STRING)) AS values")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        derive(rows, chain(20, "1"), output="wide").explain(mode="codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000  # beyond it HotSpot interprets a method


@pytest.mark.parametrize("start, factor", [("3", "2.5"), ("1e7", "1"), ("9999999.5", "1"), ("-1e-4", "0.1"), ("0.1", "3"), ("1e300", "1e10"), ("nan", "2"), ("-0.0", "1")])
def test_texts_of_a_chain_are_those_of_python(spark, start, factor):
    rows = spark.createDataFrame([("1", {"x": start})], "response_id string, values map<string,string>")
    got = derive(rows, chain(9, factor), output="wide").first()
    x = float(start)
    for i in range(9):
        x *= float(factor)
        assert got[f"c{i}"] == str(x)


def test_answers_that_variables_overwrite_are_read_at_any_depth(spark):
    rules = [*chain(9, "2"), rule("late", 0, "merge", a="c8", b="c3"), rule("c7", 1, "product", a="c7", A="10")]
    rows = spark.createDataFrame([("1", {"x": "1", "c5": "a", "c8": "7", "late": None}), ("2", {"c3": "1_0", "c7": "x"}), ("3", {"x": "1"}), ("4", None)],
                                 "response_id string, values map<string,string>")
    got = {r.response_id: r for r in derive(rows, rules, output="wide").collect()}
    assert [got["1"][f"c{i}"] for i in (0, 5, 8)] == ["2.0", "64.0", "512.0"] and got["1"]["late"] == "512.016.0" and got["1"]["c7"] == "2560.0"
    assert got["2"]["c3"] == "1_0" and got["2"]["c4"] == "20.0" and got["2"]["c7"] == "1600.0" and got["2"]["c0"] is None
    assert got["3"]["c8"] == "512.0" and got["4"]["c8"] is None
