"""Typed answers: ``equal_string`` with the answers' JSON kinds beside their texts, against plain Python."""

import json
import random

from pyspark.sql import functions as F

from varloom import derive, rule
from varloom.session import work_dir
from varloom.sources import snapshots as snap

POOL = [1, "1", 1.0, "1.0", True, "True", None, "None", "", [1], "[1]", {"a": 1}, '{"a":1}', "é", 0, "0"]
LITS = ["1", "1.0", "True", "None", "", "[1]", "é", "0", None]


def landed(spark, answers):
    root = work_dir(spark, "kinds")
    lines = [(json.dumps({"responseId": f"R{i}", "values": a}),) for i, a in enumerate(answers)]
    rows = spark.createDataFrame(lines, "value string")
    rows.write.text(f"{root}/process_timestamp=20240101 000000/survey_id=SV_1")
    return snap.read_snapshot(spark, root, kinds="kinds")


def test_kinds_of_answers(spark):
    names = {str: "string", int: "number", float: "number", bool: "boolean", list: "array", dict: "object", type(None): "null"}
    got = landed(spark, [{f"q{i}": x for i, x in enumerate(POOL)}]).first()["kinds"]
    assert got == {f"q{i}": names[type(x)] for i, x in enumerate(POOL)}


def test_equal_string_tells_strings_from_numbers(spark):
    rng = random.Random(4)
    answers = [{k: rng.choice(POOL) for k in ("q1", "q2") if rng.random() < 0.9} for _ in range(300)]
    rules = [rule(f"v{i}", 0, "conditional", "equal_string", a="q1", A=lit, then="same", otherwise="other") for i, lit in enumerate(LITS)]
    rows = landed(spark, answers)
    for mode in ("intended", "observed"):
        for r in derive(rows, rules, mode=mode, output="wide", kinds="kinds").collect():
            a = answers[int(r["response_id"][1:])]
            for i, lit in enumerate(LITS):
                want = None if "q1" not in a else "same" if a["q1"] == lit else "other"
                assert r[f"v{i}"] == want, (a, lit)


def test_derived_values_have_kinds(spark):
    rows = landed(spark, [{"q1": 1, "q2": "1"}, {"q1": "2", "q2": 0}])
    rules = [rule("tot", 0, "sum", a="q1,q2"), rule("text", 0, None, a="q1"), rule("lit", 0, "conditional", "equal", a="q1", A="1", then="2.0", otherwise="x"),
             rule("both", 0, "merge", a="q1", b="q2"), rule("q1", 1, "conditional", "greater_than", a="q2", A="5", then="1")]
    checks = [("tot", "2.0"), ("text", "1"), ("lit", "2.0"), ("both", "11"), ("q1", "1")]
    rules += [rule(f"is_{v}", 2, "conditional", "equal_string", a=v, A=lit, then="y", otherwise="n") for v, lit in checks]
    typed = derive(rows, rules, output="wide", kinds="kinds").orderBy("response_id").collect()
    assert [[r[f"is_{v}"] for v, _ in checks] for r in typed] == [["n", "y", "y", "y", "n"], ["n", "n", "n", "n", "n"]]
    plain = derive(rows, rules, output="wide").orderBy("response_id").first()
    assert [plain[f"is_{v}"] for v, _ in checks] == ["y"] * 5  # texts only
    assert typed[0]["kinds"] == {"q1": "number", "q2": "string"}
    assert derive(rows.withColumn("kinds", F.lit(None).cast("map<string,string>")), rules, output="wide", kinds="kinds").count() == 2
