import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import (extract_player_id, lineup_hash, overround_pct3, py_round,
                                spread_fraction, spread_pct2, split_part_int, strip_whitespace)


def test_py_round_is_python_round(spark):
    import random
    rnd = random.Random(11)
    vals = [1.005, 2.675, 0.125, 0.375, -1.5, 2.5, -2.675, 7.2049999, 1e-9, -0.001, 0.0, 1e17, 123.4565]
    vals += [rnd.randint(-10**6, 10**6) / 1000 + rnd.choice([0, 5e-4, -5e-4]) for _ in range(3000)]
    vals += [rnd.uniform(-50, 50) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (2, 3):
        got = [r[0] for r in df.select(py_round(F.col("x"), digits)).collect()]
        want = [round(v, digits) for v in vals]
        assert [repr(g) for g in got] == [repr(w) for w in want]


def _py_spread(h, d, a):
    return round(((1 / h) + (1 / d) + (1 / a) - 1) * 100, 2)


def _py_overround(h, d, a):
    if h and d and a:
        return round(((1 / h + 1 / d + 1 / a) * 100) - 100, 3)
    return None


def test_odds_measures(spark):
    rows = [(2.1, 3.3, 3.6), (1.5, 4.0, 6.5), (1.01, 15.0, 30.0), (None, 3.0, 2.0), (0.0, 3.0, 2.0)]
    df = spark.createDataFrame(rows, "h double, d double, a double")
    out = df.select(spread_fraction(F.col("h"), F.col("d"), F.col("a")).alias("f"),
                    spread_pct2(F.col("h"), F.col("d"), F.col("a")).alias("p2"),
                    overround_pct3(F.col("h"), F.col("d"), F.col("a")).alias("o3")).collect()
    for (h, d, a), r in zip(rows, out):
        if h is None or h == 0:
            assert r.o3 is None
            assert r.f is None  # 1/NULL and 1/0 give NULL, never an error
            continue
        assert r.f == pytest.approx((1 / h + 1 / d + 1 / a) - 1.0, abs=1e-15)
        assert r.p2 == _py_spread(h, d, a)
        assert r.o3 == _py_overround(h, d, a)


def test_strip_matches_python(spark):
    samples = [" a ", "\tb\n", "\u00a0 c\u3000", "d", "  ", "e\u2003", "\x1cf", "g h"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(strip_whitespace(F.col("s"))).collect()]
    assert got == [s.strip() for s in samples]


def test_extract_player_id(spark):
    df = spark.createDataFrame([("p123x45",), ("none",), (None,), ("007",)], "s string")
    got = [r[0] for r in df.select(extract_player_id(F.col("s"), T.StringType())).collect()]
    assert got == [123, 0, 0, 7]
    dd = spark.createDataFrame([(12345678.0,), (None,), (3.0,)], "x double")
    got = [r[0] for r in dd.select(extract_player_id(F.col("x"), T.DoubleType())).collect()]
    assert got == [12345678, 0, 3]  # not the leading digit of 1.2345678E7


def test_lineup_hash(spark):
    rows = [(1, 1, [5, 0, 3, 9]), (1, 0, [0, 0, 4, 0]), (2, 1, [9, 3, 5, 0])]
    df = spark.createDataFrame(rows, "id_match long, local int, players array<int>")
    got = [r[0] for r in df.select(lineup_hash(F.col("players"), F.col("id_match"), F.col("local"))).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[0] == sha("3|5|9")
    assert got[1] == sha("1|0")          # fewer than three known players
    assert got[2] == got[0]              # order-insensitive


def test_split_part_int(spark):
    df = spark.createDataFrame([("2014/2015",), ("2014",), ("x/y",), (None,)], "s string")
    got = [(r[0], r[1]) for r in df.select(split_part_int(F.col("s"), "/", 0),
                                            split_part_int(F.col("s"), "/", 1)).collect()]
    assert got == [(2014, 2015), (2014, None), (None, None), (None, None)]
