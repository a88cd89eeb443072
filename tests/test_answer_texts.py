"""Landed answers: read once where their text is plain, with their kinds where it is not; landed files are noted unread."""

from __future__ import annotations

import contextlib
import io
import json
import re

from pyspark.sql import functions as F

from varloom.operators.derive import derive
from varloom.plans.catalog import FLAGSHIP_RULES
from varloom.sources.snapshots import parse_responses
from varloom.streaming import ingest

VALUES = ["", "x", "12", "-12", "007", "1.50", "true", "True", "null", "NaN", "Infinity", "[1, 2]", "{a}", "-", "+1", ".5", "1e5", "2024-01-01", "a\nb", "12\n",
          12, -12, 0, 10**25, 1.5, -2.0, 1e20, 1e-7, True, False, None, [1, 2.0, "a", True, None], ["it's"], [], "\\", '"', "é", "responses"]


def python_text(x):
    return None if x is None else str(x)


def read(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    return parse_responses(rows, F.lit("20240101 000000"), F.lit("s")).collect()


def test_texts_of_answers_are_those_of_python_alone_and_side_by_side(spark):
    alone = read(spark, [json.dumps({"responseId": str(i), "values": {"a": v, "b": "y"}}) for i, v in enumerate(VALUES)])
    assert {int(r.response_id): r["values"]["a"] for r in alone} == {i: python_text(v) for i, v in enumerate(VALUES)}
    assert all(r["values"]["b"] == "y" for r in alone)
    whole = read(spark, [json.dumps({"responses": [{"responseId": "1", "values": {f"k{i}": v for i, v in enumerate(VALUES)}}]})])
    assert whole[0]["values"] == {f"k{i}": python_text(v) for i, v in enumerate(VALUES)}


def test_a_repeated_key_stays_one_key(spark):
    row = read(spark, ['{"responseId":"1","values":{"a":1,"a":2,"b":"x"}}'])[0]
    assert sorted(row["values"]) == ["a", "b"]


def test_responses_under_an_escaped_key_and_texts_that_name_it(spark):
    assert [r.response_id for r in read(spark, ['{"respons\\u0065s":[{"responseId":"1","values":{}}]}'])] == ["1"]
    assert [r.response_id for r in read(spark, ['{"responseId":"2","values":{"a":"responses"}}'])] == ["2"]


def test_methods_of_seven_sums_stay_below_the_limit_of_the_jvm(spark):
    rows = spark.range(4).selectExpr("CAST(id AS STRING) AS response_id", "map('qty_1', CAST(id AS STRING)) AS values")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        derive(rows, FLAGSHIP_RULES, output="wide").explain(mode="codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000  # beyond it HotSpot interprets a method


def test_the_ledger_notes_files_without_reading_them(spark, tmp_path):
    folder = tmp_path / "landing" / "process_timestamp=20240101 000000" / "survey_id=a%3Ab"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"responseId":"1","values":{"a":"1"}}\n{"responseId":"2","values":{"a":"2"}}\n')
    (folder / "part-1.json").write_text('{"responseId":"3","values":{"a":"3"}}\n')
    found = []
    files = ingest._files(spark, str(tmp_path / "landing"), None)
    (files.writeStream.foreachBatch(lambda df, batch: found.extend(df.collect())).option("checkpointLocation", str(tmp_path / "seen"))
     .trigger(availableNow=True).start()).awaitTermination()
    assert sorted(r.path[-6:] for r in found) == ["0.json", "1.json"]  # a row per file, not per line
    assert {(r.process_timestamp, r.survey_id) for r in found} == {("20240101 000000", "a:b")}
    args = (str(tmp_path / "landing"), str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    assert ingest.ingest_available(spark, *args) == 3 and ingest.ingest_available(spark, *args) == 0
