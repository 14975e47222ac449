"""Exact quantiles (linear interpolation, as pandas ``describe`` / SQL
``percentile``) by counting in bins, without gathering a column into one task.

Each needed rank starts with the interval [min, max] of its column. A round
cuts every open interval into ``BINS`` equal bins, counts the values of each bin
(combined map-side, so a task sends at most one row per bin whatever the number
of rows) and notes the smallest and largest value of the bin. The bin that holds the rank is the next
interval, from that smallest to that largest value, so one far outlier costs a
round, not a long chain of halvings. A rank is found when its interval holds a
single value, or when it is the first or the last of its interval.

A round always shrinks an interval (its two ends fall into different bins), and
the same steps run at every size. The first round makes one cell of a row's column, later ones
drop the rows that lie in no open interval before anything is unpivoted. Only one row per open rank reaches the driver.
NULL and NaN are missing; infinities have bins of their own.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.reference_data import literal_rows
from .columns import present

BINS = 4096

_RANKS = T.StructType([
    T.StructField("rank_no", T.IntegerType()),
    T.StructField("interval_no", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


def finite(x):
    """``x`` without infinities (for the ends of the first interval)."""
    return F.when(F.abs(x) < F.lit(math.inf), x)


def _bin(x, lo: float, hi: float):
    """Bin of a value of [lo, hi]; monotone in ``x``, 0 for ``lo`` and BINS - 1 for ``hi``."""
    half = 1.0 if math.isfinite(hi - lo) else 0.5          # hi - lo may be beyond the largest double
    width = hi * half - lo * half
    if width == 0:
        return F.lit(0)
    part = F.floor((x * F.lit(half) - F.lit(lo * half)) / F.lit(width) * F.lit(float(BINS)))
    return F.least(part, F.lit(BINS - 1)).cast("int")


def _first_bin(x, lo: float | None, hi: float | None):
    """Bins of a whole column: -1 and BINS hold the infinities."""
    inner = _bin(x, lo, hi) if lo is not None else F.lit(0)
    return (F.when(x == F.lit(-math.inf), F.lit(-1)).when(x == F.lit(math.inf), F.lit(BINS)).otherwise(inner))


def _any_open(df: DataFrame, intervals: list[tuple]) -> Column:
    """Whether a row has a value in some interval."""
    return reduce(lambda a, b: a | b, [present(df, c).isNotNull() if whole else present(df, c).cast("double").between(F.lit(lo), F.lit(hi))
                                       for c, lo, hi, whole in intervals])


def _round(df: DataFrame, intervals: list[tuple], ranks: list[tuple]) -> list:
    """One counting round. ``intervals``: (col, lo, hi, whole column?); ``ranks``:
    (rank_no, interval_no, offset of the rank from the interval's start). Returns per
    rank its bin's smallest and largest value, count, and the rows before the bin."""
    # the intervals of a column share no value, so a row has one cell for it at most
    cells: dict[str, Column] = {}
    for no, (col, lo, hi, whole) in enumerate(intervals):
        x = present(df, col).cast("double")
        inside = x.isNotNull() if whole else x.between(F.lit(lo), F.lit(hi))
        cell = F.struct(F.lit(no).alias("interval_no"), (_first_bin(x, lo, hi) if whole else _bin(x, lo, hi)).alias("bin"), x.alias("v"))
        cells[col] = cells[col].when(inside, cell) if col in cells else F.when(inside, cell)
    names = [f"c{k}" for k in range(len(cells))]
    # rows without an open cell go before they are unpivoted
    wide = df.where(_any_open(df, intervals)).select(*[c.alias(n) for n, c in zip(names, cells.values())])
    long = wide.unpivot([], names, "column", "cell").where(F.col("cell").isNotNull()).select("cell.*")
    counted = long.groupBy("interval_no", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    # at most BINS + 2 rows per interval
    upto = Window.partitionBy("interval_no").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    wanted = F.broadcast(literal_rows(df.sparkSession, ranks, _RANKS))      # one row per open rank
    return (summed.join(wanted, "interval_no")
            .where((F.col("before") <= F.col("offset")) & (F.col("offset") < F.col("before") + F.col("n")))
            .select("rank_no", "lo", "hi", "n", "before").collect())


def exact_order_statistics(df: DataFrame, needed: list[tuple[str, int]],
                           ends: dict[str, tuple]) -> dict[tuple[str, int], float]:
    """{(col, rank): value}, ranks from 0 among the column's present values."""
    found: dict[tuple[str, int], float] = {}
    # open rank -> (lo, hi, whole column?, offset of the rank from the start of the interval)
    open_ranks = {(c, r): (*ends[c], True, r) for c, r in needed}
    while open_ranks:
        intervals = list(dict.fromkeys((c, lo, hi, whole) for (c, _), (lo, hi, whole, _) in open_ranks.items()))
        keys = list(open_ranks)
        ranks = [(i, intervals.index((k[0], *open_ranks[k][:3])), open_ranks[k][3]) for i, k in enumerate(keys)]
        nxt = {}
        for row in _round(df, intervals, ranks):
            key = keys[row.rank_no]
            offset = open_ranks[key][3] - row.before
            if row.lo == row.hi or offset == 0:
                found[key] = row.lo
            elif offset == row.n - 1:
                found[key] = row.hi
            else:
                nxt[key] = (row.lo, row.hi, False, offset)
        open_ranks = nxt
    return found


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    counts: dict[str, int] | None = None, ends: dict[str, tuple] | None = None) -> dict:
    """{col: {p: quantile}} with linear interpolation between order statistics.

    ``counts`` and ``ends`` ({col: (smallest, largest finite value)}) save a pass
    when the caller has them."""
    if counts is None or ends is None:
        xs = [present(df, c).cast("double") for c in cols]
        row = df.agg(*[f(x).alias(f"{name}{i}") for i, x in enumerate(xs) for name, f in
                       (("n", F.count), ("lo", lambda x: F.min(finite(x))), ("hi", lambda x: F.max(finite(x))))]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
        ends = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
    plan, needed = {}, {}
    for c in cols:
        for p in probs:
            if not counts[c]:
                continue
            pos = p * (counts[c] - 1)
            k = math.floor(pos)
            up = k + 1 if pos > k and k + 1 < counts[c] else k
            plan[c, p] = (k, up, pos - k)
            needed |= {(c, k): None, (c, up): None}
    value = exact_order_statistics(df, list(needed), ends)
    out: dict = {c: {p: None for p in probs} for c in cols}
    for (c, p), (k, up, frac) in plan.items():
        low, high = value[c, k], value[c, up]
        out[c][p] = low if low == high else low + (high - low) * frac
    return out
