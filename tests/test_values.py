"""Coercion helpers against Python's own float()/repr."""

import ast
import math
import random
import statistics

import numpy as np
import pytest

from varloom.functions.values import exact_mean, list_numbers, list_text, plain_number, py_float_text, py_num, sql_double, sql_str

# Edge literals from FIXTURES.md.
NUMERIC_TEXT = ["1", "1.0", " 1 ", "+5", "-3", ".5", "5.", "1e5", "1_000", "inf", "nan", "-inf",
                "Infinity", "-nan", "1e400", "1d", "1.5f", "0x1p3", "", "abc", "None", "1L", "-99",
                "1__0", "_1", "1_", "\t7\n", "+-1", "1e", "e5", "."]


def py_ref(t):
    try:
        return float(t)
    except ValueError:
        return None


def test_py_num_matches_python(spark):
    rows = spark.createDataFrame([(t,) for t in NUMERIC_TEXT], "t string")
    got = [r[0] for r in rows.selectExpr(py_num("t")).collect()]
    for t, g in zip(NUMERIC_TEXT, got):
        want = py_ref(t)
        if want is None:
            assert g is None, t
        elif math.isnan(want):
            assert g is not None and math.isnan(g), t
        else:
            assert g == want, t


FLOATS = [1e8, 1e20, 0.30000000000000004, 1e-4, 1.5e-7, 123.456, 1e7, 12345678.9, -0.0, 5.0, 1e16,
          1e300, 0.001, -1.5e-5, 2.5e15, 1234567890123456.0, -12345678.9, -1e-4, 9.999e-4, 1e-300,
          float("nan"), float("inf"), -float("inf")]


def test_float_text_matches_repr(spark):
    df = spark.createDataFrame([(v,) for v in FLOATS], "x double")
    got = [r[0] for r in df.selectExpr(py_float_text("x")).collect()]
    assert got == [repr(v) for v in FLOATS]


@pytest.mark.parametrize("text,want", [
    ("1,2", [1.0, 2.0]), ("[1, 2]", [1.0, 2.0]), ('["1","2"]', [1.0, 2.0]), ("[]", []), ("", []),
    ("1,2,", [1.0, 2.0]), ("3.5", [3.5]), ("[1,,2]", "error"), ("abc", "error"), (None, "error"),
    ("[[1]]", "error"), ("'4'", [4.0]), ("[,]", "error"), ("[1, '2', \"3\" ,]", [1.0, 2.0, 3.0]), ("[ ]", []), ("1_0", [10.0]),
])
def test_list_numbers(spark, text, want):
    got = spark.sql(f"SELECT {list_numbers('w')} AS a FROM (SELECT {list_text(sql_str(text))} AS w)").first().a
    if want == "error":
        assert got is None or any(x is None for x in got)
    else:
        assert got == want


def test_exact_mean_matches_statistics(spark):
    import random
    import statistics

    rng = random.Random(8)
    lists = [[0.1, 0.2, 0.3], [1e16, 1.0, -1e16], [5.0], [1e-300, 1e300], [0.1] * 10, [-0.3, 0.1, 0.2]]
    lists += [[round(rng.uniform(-50, 50), rng.choice([1, 2, 3, 17])) for _ in range(rng.randrange(1, 9))] for _ in range(400)]
    got = [spark.createDataFrame([tuple(x)], ", ".join(f"c{i} double" for i in range(len(x)))).selectExpr(
        exact_mean([f"c{i}" for i in range(len(x))])) for x in lists[:6]]
    assert [g.first()[0] for g in got] == [statistics.mean(x) for x in lists[:6]]
    width = 8
    rows = [tuple(x) + (None,) * (width - len(x)) for x in lists if len(x) <= width]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(width)))
    got = [r[0] for r in df.coalesce(1).selectExpr(exact_mean([f"c{i}" for i in range(width)])).collect()]
    want = [statistics.mean(v for v in r if v is not None) for r in rows]
    assert got == want
    assert sql_double(1.5)


def test_number_text_is_the_shortest(spark):
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) | (rng.integers(0, 2, 60_000, dtype=np.uint64) << np.uint64(63))
    numbers = np.concatenate([bits.view(np.float64), rng.uniform(-100, 100, 20_000), rng.uniform(0, 50, 20_000) * rng.uniform(0, 1e20, 20_000),
                              np.round(rng.uniform(-1e4, 1e4, 10_000), 3), rng.integers(-10**9, 10**9, 5_000) / 7.0, 10.0 ** np.arange(-320, 309),
                              2.0 ** np.arange(-1074, 1024), [0.002, -0.0, 0.0, 2e-44, 1e23, 5e-324, 9007199254740993.0, 1.7976931348623157e308]])
    frame = spark.createDataFrame([(float(x),) for x in numbers], "x double")
    rows = frame.selectExpr("x", f"{py_float_text('x')} AS t").collect()
    wrong = [(r["x"], r["t"]) for r in rows if r["t"] != repr(r["x"])]
    assert len(rows) > 100_000 and not wrong, wrong[:5]


def test_mean_over_the_full_range(spark):
    rng = np.random.default_rng(5)
    rows = [(1e308, 1e308, 0.5), (1.7e308, 1.7e308, -1.7e308), (5e-324, 5e-324, 1e-323), (5e-324, 0.0, 0.0), (2.5e-310, 1.1e-309, 3e-320), (1e308, -1e308, 1.5),
            (0.1, None, 0.2), (1e-205, 3e-210, 0.7e-205)]
    rows += [tuple(float(v) for v in rng.uniform(-1, 1, 3) * 10.0 ** rng.integers(-307, 308)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    got = [r[0] for r in frame.selectExpr(exact_mean(["a", "b", "c"])).collect()]
    want = [float(statistics.mean([v for v in r if v is not None])) for r in rows]
    wrong = [(r, g, w) for r, g, w in zip(rows, got, want, strict=True) if g != w]
    assert not wrong, wrong[:5]


def python_list(text):
    """Numbers of an answer as the list reading of Python gives them; None where it raises."""
    try:
        return [float(x) for x in ast.literal_eval(text if "[" in text else f"[{text}]")]
    except (ValueError, TypeError, SyntaxError):
        return None


def test_list_literals_are_read_as_python_reads_them(spark):
    rng = random.Random(11)
    elements = ["1", "007", "00", "0", "-0", "007.5", "07e1", "0x1F", "-0xff", "0X_a", "0o17", "0o8", "0b101", "0b2", "0x", "True", "False", "-True", "true", "None",
                "[1]", "[]", "1_000", "1__0", "_1", "1_", "- 1", "+ 2", "--1", "1 2", "1.", ".5", "1e5", "1e400", "'3'", "' 4 '", '"5.5"', "'x'", "'007'", "'0x1'", "'nan'",
                "nan", "inf", "", "abc", "1-2", "0_0", "0_7", "0xFFFFFFFFFFFFFFFF", "0b" + "1" * 64, "0o1777777777777777777777", "0x00000000000000000000001", "-0b0"]
    texts = elements + [f"[{x}]" for x in elements] + [f" {x} " for x in elements]
    texts += [rng.choice(["[{}]", "{}", "[{},]", "[ {} ]"]).format(rng.choice([",", ", "]).join(rng.choices(elements, k=rng.randint(2, 4)))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"{py_num('t')} AS n").selectExpr(
        "t", "n", f"{plain_number('t', 'n')} AS plain", f"{list_text('t')} AS w").selectExpr("t", "n", "plain", f"{list_numbers('w')} AS a")
    wrong = []
    for r in frame.collect():
        got = [r.n] if r.plain else None if r.a is None or None in r.a else r.a
        want = python_list(r.t.strip())
        plus = [xs and [x + 0.0 for x in xs] for xs in (got, want)]  # they are only summed: the sign of a zero does not count
        if repr(plus[0]) != repr(plus[1]):
            wrong.append((r.t, got, want))
    assert not wrong, (len(wrong), wrong[:12])
