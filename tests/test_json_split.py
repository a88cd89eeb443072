"""Landed JSON documents cut in blocks: the same responses as the whole document read by Python."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from varloom.sources import json_split, snapshots

TRICKY = ['}', '{', ']', '["', '"', '\\', '\\"', '\\\\', '"responses": [', '{"responses": [{', '],"x":{', 'é漢🙂', '\n', ', ', ' plain ', 'a' * 50]


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind < 2:
        return "".join(rng.choice(TRICKY) for _ in range(rng.randrange(4)))
    if kind == 2:
        return rng.choice([1, -2.5, 1e30, True, None])
    if kind == 3:
        return ""
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    key = lambda: rng.choice(["responses", "k", "}", "{", '"'])
    return {key(): value(rng, depth + 1) for _ in range(rng.randrange(3))}


def document(rng, kind, n):
    items = [{"responseId": f"r{i}", "values": {"q": value(rng), "responses": value(rng), "z}": value(rng)}, "more": value(rng)} for i in range(n)]
    if kind == "array":
        return items, items
    if kind == "single":
        return items[0], items[:1]
    out = {"meta": {"a": [{"b": {}}], "responses": [{"no": 1}]}} if kind == "late" else {}
    return {**out, "responses": items, "links": [{"x": {"y": {}}}, "} ]"]}, items


def write(path, doc, rng):
    text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]))
    os.makedirs(os.path.dirname(path))
    with open(path, "w", encoding=rng.choice(["utf-8", "utf-8-sig"])) as f:
        f.write(text + rng.choice(["", "\n", "  \n"]))


@pytest.fixture
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (size, 0), strict=True)]
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [97, 700, 1 << 20])
def test_equals_the_whole_documents(spark, small_blocks, size):
    rng = random.Random(size)
    root, want = tempfile.mkdtemp(), {}
    for i, kind in enumerate(["array", "listed", "late", "single", "array", "listed", "late", "single"]):
        doc, items = document(rng, kind, rng.choice([1, 3, 25]))
        write(f"{root}/ns/20240101 000000/SV_{i}/survey_responses.json", doc, rng)
        want[f"SV_{i}"] = items
    for i, doc in enumerate(([], {"responses": []}, {"responses": [], "x": [{"y": 1}]})):
        write(f"{root}/ns/20240101 000000/E_{i}/survey_responses.json", doc, rng)
    small_blocks(size)
    got = {}
    for r in snapshots.read_snapshot(spark, root, layout="plain").select("survey_id", "response").collect():
        got.setdefault(r["survey_id"], []).append(json.loads(r["response"]))
    order = lambda rows: sorted(rows, key=lambda r: int(r["responseId"][1:]))
    assert {k: order(v) for k, v in got.items()} == want


def test_a_document_is_read_by_many_tasks_and_no_value_is_long(spark, small_blocks):
    root = tempfile.mkdtemp()
    items = [{"responseId": str(i), "values": {"q": i, "text": "word } " * 20}} for i in range(20_000)]
    write(f"{root}/ns/20240101 000000/SV_1/survey_responses.json", {"responses": items}, random.Random(1))
    small_blocks(200_000)
    rows = json_split.segments(spark, root, "*.json", lambda p: p)
    assert rows.rdd.getNumPartitions() > 10
    assert rows.select(F.max(F.octet_length("value"))).first()[0] < 1_000
    back = snapshots.read_snapshot(spark, root, layout="plain")
    assert back.agg(F.count("*"), F.countDistinct("response_id"), F.sum(F.col("values")["q"].cast("long"))).first() == (20_000, 20_000, sum(range(20_000)))


