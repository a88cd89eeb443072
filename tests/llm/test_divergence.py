"""Source divergence audit against its SQL, on texts and groups that need several blocks of either."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from varloom.llm import divergence
from varloom.session import work_dir

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string"


def by_sql(df):
    folder = work_dir(df.sparkSession, "test-divergence").removeprefix("file:")
    df.select("doc_id", "text", "lang", "source").write.parquet(folder)
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/*.parquet'")
    return c.sql(f"SELECT {', '.join(COLUMNS)} FROM ({divergence.ORACLE})").fetchall()


def check(df):
    got = sorted(tuple(r) for r in divergence.audit(df).select(COLUMNS).collect())
    assert got == sorted(by_sql(df))
    return got


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in ["u", "Ü", "z漢", "x"]]
    out = []
    for i in range(900):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))
        out.append((i, text, rng.choice(["en", "de"]), f"s{rng.randrange(40)}"))
    out += [(None, None, None, None), (5, None, "en", None), (6, "", "fr", "only"), (7, "AbC-abc\x01ABC 1abc2 Ünï", "fr", "two")] * 3
    out += [(8, "once", "it", "a"), (8, "twice", "it", "b"), (9, "...", "it", "c")]
    return out


def test_equals_sql_over_several_blocks_of_groups(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("n", "p", "value", "rank", "term", "item", "df", "g", "block", "number"):
        df = df.withColumn(c, F.lit(c))
    got = check(df)
    assert {r[4] for r in got if r[0] == "it"} == {0}  # no kept term: pairs of value 0
    assert sum(r[0] == "en" and r[1] == "s1" and r[2] == "pair" for r in got) > divergence.GROUPS


def test_several_blocks_of_terms_and_top(spark):
    terms = 3 * divergence.TERMS
    def name(i):
        return "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    texts = [" ".join(name(i) for i in range(start, terms, 7)) for start in (0, 0, 0, 3, 3, 3)]
    texts[5] += (" " + name(3)) * 100_000  # a text of more than one part
    df = spark.createDataFrame([(i, t, "x", f"s{i % 2}") for i, t in enumerate(texts)], SCHEMA)
    got = check(df)
    assert max(r[5] for r in got) == divergence.TOP


def test_parts_of_a_text_cut_no_word(monkeypatch):
    monkeypatch.setattr(divergence, "PART", 7)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aB 1é\n") for _ in range(rng.randrange(60))).encode()
        whole = text.translate(divergence._FOLD).split()
        assert Counter(w for part in divergence._words(text) for w in part) == Counter(whole)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_group(spark):
    got = check(spark.createDataFrame([(i, "a b c", "x", "s") for i in range(4)], SCHEMA))
    assert got == []
