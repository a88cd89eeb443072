"""Sources, sinks and streaming: tokens, catalogue, snapshots, CSV header, ingest."""

import csv
import io
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from varloom import rule
from varloom.plans import catalog
from varloom.plans.catalog import FLAGSHIP_RULES
from varloom.session import work_dir
from varloom.sources import fixtures as fx
from varloom.sources import snapshots as snap
from varloom.sources import surveys as sv
from varloom.sources import tokens as tk
from varloom.streaming.ingest import Ledger, ingest_available, read_sink

SF0001 = "/root/testdata/sf0.001"


def test_latest_token_and_empty_default(spark):
    t = spark.createDataFrame(
        [("s1", "a", "2024-01-01 00:00:00"), ("s1", "b", "2024-01-02 00:00:00"), ("s2", "c", "2024-01-01 00:00:00"),
         ("s2", "d", "2024-01-01 00:00:00")], "survey_id string, continuation_token string, created_at string"
    ).withColumn("created_at", F.to_timestamp("created_at"))
    s = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "survey_id string")
    got = {r.survey_id: r.continuation_token for r in tk.latest_tokens(t, s).collect()}
    assert got == {"s1": "b", "s2": "d", "s3": ""}


def test_token_store_append(spark):
    store = work_dir(spark, "t-tokens")
    tk.append_tokens(spark.createDataFrame([("s1", "x")], "survey_id string, continuation_token string"), store)
    tk.append_tokens(spark.createDataFrame([("s1", "y")], "survey_id string, continuation_token string"), store)
    rows = tk.read_tokens(spark, store).collect()
    assert len(rows) == 2 and all(r.created_at is not None for r in rows)


def test_survey_list_document(spark):
    d = tempfile.mkdtemp(prefix="vl-list-")
    with open(os.path.join(d, "surveys.json"), "w") as f:
        json.dump({"result": {"elements": [{"id": "SV_a", "name": "A", "isActive": True},
                                           {"id": "SV_b", "name": "B", "isActive": False},
                                           {"id": "SV_c", "name": "C", "isActive": None}]}}, f, indent=2)
    got = sorted(r.survey_id for r in sv.active_surveys(sv.read_survey_list(spark, d)).collect())
    assert got == ["SV_a"]


def test_plain_landed_pages(spark, monkeypatch):
    monkeypatch.setattr(catalog, "PAGE", 50, raising=False)
    root = catalog._plain_tree(spark, SF0001)
    held = [len(json.loads(r.value)["responses"]) for r in spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).collect()]
    r2 = fx.order_responses(spark, SF0001)
    assert sum(held) == r2.count() > 1000 and max(held) <= 100
    back = snap.read_snapshot(spark, root, layout="plain")
    ids = lambda df: sorted((r.response_id, r.survey_id) for r in df.select(F.col("response_id").cast("string"), "survey_id").collect())
    assert ids(back) == ids(r2)


def test_plain_landed_layout(spark):
    root = tempfile.mkdtemp(prefix="vl-landed-")
    path = os.path.join(root, "surveys", "ns", "20240101 101500", "SV_x")
    os.makedirs(path)
    with open(os.path.join(path, "survey_responses.json"), "w") as f:
        json.dump([{"responseId": "R_1", "values": {"q1": 3, "q2": "a", "q3": None, "q4": [1, 2]}},
                   {"responseId": "R_2", "values": {"q1": 1.5}}], f, indent=2)
    rows = {r.response_id: r for r in snap.read_snapshot(spark, root, layout="plain").collect()}
    assert rows["R_1"].survey_id == "SV_x"
    assert str(rows["R_1"].process_timestamp) == "2024-01-01 10:15:00"
    assert rows["R_1"]["values"]["q1"] == "3" and rows["R_1"]["values"]["q3"] is None
    assert rows["R_1"]["values"]["q4"] == "[1, 2]"
    from varloom import derive, rule

    tot = derive(snap.read_snapshot(spark, root, layout="plain"), [rule("t", 0, "sum", a="q4,q1")], output="wide")
    assert {r.response_id: r.t for r in tot.collect()} == {"R_1": "6.0", "R_2": "1.5"}
    assert rows["R_2"]["values"] == {"q1": "1.5"}


def test_snapshot_roundtrip_and_dynamic_overwrite(spark):
    root = work_dir(spark, "t-snap")
    r2 = fx.order_responses(spark, SF0001)
    snap.write_snapshot(r2, root, "20240101 000000")
    snap.write_snapshot(r2.filter("survey_id = 'SV_1'"), root, "20240101 000000")
    back = snap.read_snapshot(spark, root)
    assert back.count() == r2.count()
    assert back.filter("survey_id = 'SV_2'").count() == r2.filter("survey_id = 'SV_2'").count()


def test_csv_header_roundtrip(spark):
    path = work_dir(spark, "t-csv")
    r2 = fx.order_responses(spark, SF0001)
    snap.write_csv_header(r2, path)
    got = snap.read_csv_header(spark, path).filter("survey_id = 'SV_1'").orderBy("position").collect()
    keys = [r.key for r in got]
    assert keys == sorted(keys) and "prio" in keys
    assert all(r.label == r.key.upper() for r in got)


def test_incremental_ingest_exactly_once(spark):
    landing, sink, ckpt = (work_dir(spark, n) for n in ("t-land", "t-sink", "t-ckpt"))
    r2 = fx.order_responses(spark, SF0001)
    first = F.col("survey_id").isin("SV_1", "SV_2")
    snap.write_snapshot(r2.filter(first), landing, "20240101 000000")
    n1 = ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    snap.write_snapshot(r2.filter(~first), landing, "20240102 000000")
    n2 = ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    n3 = ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    total = r2.count()
    assert n1 + n2 == total and n3 == 0
    snap.write_snapshot(r2.filter(first), landing, "20240101 000000")  # lands again: replaced, not added
    assert ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide", max_files_per_trigger=1) >= n1
    assert spark.read.parquet(sink).count() == total


def test_header_rows(spark):
    root = tempfile.mkdtemp(prefix="vl-csv-")
    path = os.path.join(root, "any", "depth", "here", "20240101 101500", "SV_y")
    os.makedirs(path)
    with open(os.path.join(path, "survey_responses.csv"), "w") as f:
        f.write('q1,"q,2"\nFirst,"Second ""two"""\n"{1}",{2}\n')
    read = lambda n: [(r.survey_id, r.position, r.key, r.label, r.import_id) for r in
                      snap.read_csv_header(spark, root, n, layout="plain").orderBy("position").collect()]
    assert read(1) == [("SV_y", 0, "q1", None, None), ("SV_y", 1, "q,2", None, None)]
    assert read(2) == [("SV_y", 0, "q1", "First", None), ("SV_y", 1, "q,2", 'Second "two"', None)]
    assert read(3)[1] == ("SV_y", 1, "q,2", 'Second "two"', "{2}")


def test_other_fields_and_typed_answers_are_kept(spark):
    root = tempfile.mkdtemp(prefix="vl-typed-")
    path = os.path.join(root, "surveys", "a", "b", "20240101 101500", "SV_z")
    os.makedirs(path)
    answers = {"q": ["a", "b'c"], "t": True, "n": 2.0, "i": 12, "z": None, "s": "true", "l": [1, 2.5, None, False]}
    with open(os.path.join(path, "survey_responses.json"), "w") as f:
        json.dump({"responses": [{"responseId": "R_1", "values": answers, "labels": {"x": "y"}}]}, f)
    r = snap.read_snapshot(spark, root, layout="plain").first()
    assert r["values"] == {k: None if v is None else str(v) for k, v in answers.items()}
    assert json.loads(r.response) == {"responseId": "R_1", "values": answers, "labels": {"x": "y"}}


def test_writes_leave_the_session_alone_and_keep_columns(spark):
    root = work_dir(spark, "t-conf")
    r2 = fx.order_responses(spark, SF0001).withColumn("language", F.lit("en"))
    snap.write_snapshot(r2, root, "20240101 000000", rows_per_file=100)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    back = snap.read_snapshot(spark, root)
    assert back.filter(F.get_json_object("response", "$.language") == "en").count() == r2.count()
    files = back.groupBy("survey_id").count().collect()
    assert sum(r["count"] for r in files) == r2.count()


def _two_surveys(spark, ids):
    rows = [(str(i), ids[i % len(ids)], {"q": str(i)}) for i in range(60)]
    return spark.createDataFrame(rows, "response_id string, survey_id string, values map<string,string>")


def test_ledger_rewrites_a_folder_once_per_run(spark):
    landing, sink, ckpt = (work_dir(spark, n) for n in ("landing", "sink", "ckpt"))
    rows = _two_surveys(spark, ["a:b", "a+b"])
    snap.write_snapshot(rows, landing, "20240101 000000", rows_per_file=5)
    assert ingest_available(spark, landing, sink, ckpt, max_files_per_trigger=1) == 60
    ledger = Ledger(spark, ckpt)
    assert ledger._read("seen").groupBy("folder").count().filter("count > 1").count() == 2
    assert ledger._read("done").count() == 2 and ledger.pending() == []
    assert ingest_available(spark, landing, sink, ckpt) == 0


def test_ledger_repeats_what_a_failed_run_left(spark):
    landing, sink, ckpt = (work_dir(spark, n) for n in ("landing", "sink", "ckpt"))
    snap.write_snapshot(_two_surveys(spark, ["x y", "k=v"]), landing, "20240101 000000")
    with pytest.raises(ValueError):  # the stream has seen the files when the rules are refused
        ingest_available(spark, landing, sink, ckpt, [rule("v", 0, "no such action", a="q")])
    assert len(Ledger(spark, ckpt).pending()) == 2
    assert ingest_available(spark, landing, sink, ckpt) == 60
    got = {r["survey_id"]: r["count"] for r in read_sink(spark, sink).groupBy("survey_id").count().collect()}
    assert got == {"x y": 30, "k=v": 30}


def test_odd_and_null_survey_ids(spark):
    ids = ["a:b", "a+b", "50%", "%2B", "007", "2024-01-01", "x[1]{2}", "é", None]
    landing, sink, ckpt = (work_dir(spark, n) for n in ("landing", "sink", "ckpt"))
    rows = _two_surveys(spark, ids)
    snap.write_snapshot(rows, landing, "20240101 000000")
    assert ingest_available(spark, landing, sink, ckpt, max_files_per_trigger=2) == 60
    want = {(r["response_id"], r["survey_id"]) for r in rows.collect()}
    assert {(r["response_id"], r["survey_id"]) for r in read_sink(spark, sink).collect()} == want
    assert {(r["response_id"], r["survey_id"]) for r in snap.read_snapshot(spark, landing).collect()} == want


def test_plain_folders_keep_their_names(spark):
    root = tempfile.mkdtemp()
    for name in ("SV+1", "SV 1", "50%", "é"):
        os.makedirs(f"{root}/ns/20240101 000000/{name}")
        with open(f"{root}/ns/20240101 000000/{name}/survey_responses.json", "w") as f:
            json.dump([{"responseId": name, "values": {"q": 1}}], f)
        with open(f"{root}/ns/20240101 000000/{name}/survey_responses.csv", "w") as f:
            f.write("q\nQuestion\n")
    rows = snap.read_snapshot(spark, root, layout="plain").collect()
    assert {(r["response_id"], r["survey_id"]) for r in rows} == {(n, n) for n in ("SV+1", "SV 1", "50%", "é")}
    assert {r["survey_id"] for r in snap.read_csv_header(spark, root, layout="plain").collect()} == {"SV+1", "SV 1", "50%", "é"}


def test_csv_records_equal_the_csv_module(spark):
    rng = random.Random(3)
    tables = []
    for _ in range(400):
        table = [["".join(rng.choice(['a', 'b c', ',', '"', '""', "\n", "\r\n", "é", "'"]) for _ in range(rng.randrange(4))) or "x"
                  for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 4))]
        text = io.StringIO()
        csv.writer(text, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=rng.choice(["\n", "\r\n"])).writerows(table)
        tables.append(text.getvalue() if rng.random() < 0.5 else text.getvalue().rstrip("\r\n"))
    tables += ["", "a", ",", "a,\n", 'a"b,"c', '"a"b,c', "a\n\nb", '""']
    df = spark.createDataFrame(list(enumerate(tables)), "i int, value string")
    got = {r["i"]: [r["a"], r["b"], r["c"]] for r in df.select("i", *(x.alias(n) for x, n in zip(snap.csv_records(F.col("value"), 3), "abc"))).collect()}
    for i, text in enumerate(tables[:400]):
        want = list(csv.reader(io.StringIO(text, newline="")))
        assert got[i] == want + [None] * (3 - len(want)), text
    assert [got[400 + i] for i in range(8)] == [
        [None, None, None], [["a"], None, None], [["", ""], None, None], [["a", ""], None, None],
        [['a"b', '"c'], None, None], [['"a"b', "c"], None, None], [["a"], [""], ["b"]], [[""], None, None]]
