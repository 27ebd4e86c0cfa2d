"""Scalar rules against plain Python on random inputs (one Spark job per test)."""

import random
import re

from pyspark.sql import functions as F

from flowlake.functions import text as T

_NUM = re.compile(r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$")


def _py_scaled(s, units, case):
    m = _NUM.match(s or "")
    if not m:
        return None
    mult = units.get(case(m.group(2)))
    return None if mult is None else int(float(m.group(1)) * mult)


def _rand_text(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(n)))


def test_capitalize_matches_python(spark):
    rng = random.Random(5)
    words = [_rand_text(rng, "abcXYZ q-_1.", 12) for _ in range(400)] + ["", "a", "ABC def", "x Y z"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(T.capitalize(F.col("w"))).collect()]
    assert got == [w.capitalize() for w in words]


def test_size_and_duration_parsing_match_python(spark):
    rng = random.Random(6)
    size_units = list(T.SIZE_UNITS) + ["kb", "Gb", "XB"]
    dur_units = list(T.DURATION_UNITS_MS) + ["SEC", "Days", "fortnights"]
    rows = []
    for _ in range(400):
        num = rng.choice(["0", "1", "40", "365", "1.5", "12.25", "", "x"])
        rows.append((f"{num}{rng.choice(['', ' ', '  '])}{rng.choice(size_units)}",
                     f"{rng.choice(['', ' '])}{num} {rng.choice(dur_units)}{rng.choice(['', ' '])}"))
    df = spark.createDataFrame(rows, "s string, d string")
    got = df.select(T.parse_data_size(F.col("s")).alias("b"), T.parse_duration_ms(F.col("d")).alias("ms")).collect()
    for (s, d), r in zip(rows, got):
        assert r["b"] == _py_scaled(s, T.SIZE_UNITS, str.upper), s
        assert r["ms"] == _py_scaled(d, T.DURATION_UNITS_MS, str.lower), d


def test_default_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "v string")
    assert [r[0] for r in df.select(T.default_text(F.col("v"), "d")).collect()] == ["d", "d", "x"]
