import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHES = ["token", "key", "n", "h", "set", "spans", "base", "gone", "score", "n_removed", "rank", "start", "slots", "at", "component"]


def edge_texts() -> list[tuple[int, str | None]]:
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Übung", "naïve", "x1", "don't", "42", "###", "o'clock"]
    long = " ".join(rng.choice(words) + str(rng.randrange(10**6)) for _ in range(20_000))
    line = "one two three four five six seven eight nine ten eleven twelve"
    passage = " ".join(f"w{i}" for i in range(60))
    return [
        (900001, None), (900002, ""), (900003, " "), (900004, "\n\n\t"), (900005, "word"), (900006, "word"), (900007, "WORD"),
        (900010, long), (900011, long), (900012, long + " end"),
        (900020, line), (900021, line + "\n" + line), (900022, "x\n" + line.upper()), (900023, line + " thirteen\nshort\n\nshort"),
        (900030, passage + " tail one"), (900031, "head " + passage), (900032, passage[5:] + " é漢🙂"),
        (900040, "▁a ▁▁ b  c \x01 <s> </s> <|endoftext|> a<|startoftext|>b"), (900041, "é漢🙂 Σας İstanbul ﬁ Å x²½"),
        (900050, "mail a.b+c@d-e.f.gh ip 1.2.3.4 999.1.1.1 1.2.3.4.5 card 4111 1111 1111 1111 4111-1111-1111-1112 tel +1 (234) 567-8901 +12"),
        (900051, "+" + "1 " * 3000 + "a@b" + ".c" * 2000 + "9" * 5000 + "@" * 50),
        (900060, "aaaa" * 200), (900061, "ab" * 400), (900062, "ab" * 400 + "!"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    """sf0.001 documents, edge rows, one repeated row, and columns with clashing names; cut in several partitions."""
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    edges = spark.createDataFrame([Row(*r) for r in edge_texts()], schema)
    out = own.union(edges)
    for c in CLASHES:
        out = out.withColumn(c, F.lit(c))
    return out.repartition(3, F.col("doc_id") % 7)


@pytest.fixture(scope="module")
def texts(docs):
    """doc_id -> text, null as empty."""
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def repeated(docs):
    """The edge rows, each twice."""
    few = docs.filter("doc_id >= 900001 and doc_id not in (900010, 900011, 900012, 900051)")
    return few.union(few)
