import math

import numpy as np
import pandas as pd
import pytest

from tierline.operators import profile, quantiles
from tierline.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("bins", [2, 16, 1024])
def test_exact_quantiles_match_numpy(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(7)
    a = np.round(rng.normal(50, 20, 3000), 3)
    b = np.concatenate([np.full(1500, 4.0), rng.integers(0, 100, 1500)]).astype(float)  # hot value
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = PROBS if bins > 2 else [0.5]
    got = exact_quantiles(df, ["a", "b"], probs)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    for p in probs:
        assert got["a"][p] == pytest.approx(np.percentile(a, p * 100), abs=1e-9)
        assert got["b"][p] == pytest.approx(np.percentile(bb, p * 100), abs=1e-9)


def test_exact_quantiles_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": {0.5: None}}


def test_outliers_and_infinities(spark):
    values = [float(i) for i in range(500)] + [1.7e308, -1.7e308, math.inf, -math.inf, math.nan, 5e-324, 1e-323]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    present = sorted(v for v in values if not math.isnan(v))
    ranks = [0, 1, 2, 3, 4, 200, len(present) - 3, len(present) - 2, len(present) - 1]
    got = exact_quantiles(df, ["a"], [r / (len(present) - 1) for r in ranks])["a"]
    for r in ranks:
        assert got[r / (len(present) - 1)] == pytest.approx(present[r], rel=1e-9)


def test_rounds_count_a_bounded_number_of_rows(spark, monkeypatch):
    """Whatever the table's size, a round leaves at most one row per bin and interval, and few rounds are needed."""
    df = spark.range(200_000).selectExpr("cast(id * id as double) a")
    rounds = []
    real = quantiles._round
    monkeypatch.setattr(quantiles, "_round", lambda d, i, r: rounds.append((len(i), len(r))) or real(d, i, r))
    got = exact_quantiles(df, ["a"], [0.25, 0.5])["a"]
    assert got[0.5] == (100_000.0 ** 2 + 99_999.0 ** 2) / 2
    assert got[0.25] == pytest.approx(49_999.0 ** 2 + 0.75 * (50_000.0 ** 2 - 49_999.0 ** 2))
    assert len(rounds) <= 3 and all(i <= 4 and r <= 4 for i, r in rounds)


def test_correlation_of_a_wide_table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1, (800, 115)).cumsum(axis=1)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 4.0                                              # constant
    pdf = pd.DataFrame(x, columns=[f"c.{i}" for i in range(115)])
    df = spark.createDataFrame(pdf)
    got = profile.corr_long(df).toPandas().pivot(index="i", columns="j", values="r").to_numpy(dtype=float)
    want = pdf.corr(min_periods=2).to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-8)
    assert np.isnan(got[7]).all()


def test_correlation_of_no_rows(spark):
    got = profile.corr_long(spark.createDataFrame([], "a double, b int"))
    assert sorted(map(tuple, got.collect())) == [(a, b, i, j, None) for i, a in enumerate("ab") for j, b in enumerate("ab")]
