"""Rows of some ids: few ids are broadcast, so a scan of the rows is the only Python worker of its task; many go through a filter."""

from __future__ import annotations

import contextlib
import io

from varloom.llm import common


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_few_ids_take_no_python_worker(spark, monkeypatch):
    docs = spark.range(100).selectExpr("CAST(id AS STRING) AS text", "id AS doc_id", "id % 3 AS more")
    ids = spark.range(7, 30).union(spark.range(20, 30)).toDF("node")  # some twice
    few = common.only_ids(docs, ids)
    assert "EvalPython" not in plan_of(few) and "BroadcastHashJoin" in plan_of(few)
    assert few.columns == docs.columns
    assert sorted(r.doc_id for r in few.collect()) == list(range(7, 30))
    monkeypatch.setattr(common, "FEW", 0)
    many = common.only_ids(docs, ids)
    assert "EvalPython" in plan_of(many)
    assert {r.doc_id for r in many.collect()} >= set(range(7, 30))
