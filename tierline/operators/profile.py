"""Profiling: completeness, uniqueness, frequencies, summaries, correlation.

Each profile is one or two passes whatever the number of columns: per-column
counts are expressions of a single aggregate, and per-column distinct counts
go through one unpivot + groupBy (combined map-side) instead of a pass per
column.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import columns_by_family, present, quoted, to_long
from .quantiles import exact_quantiles, finite
from ..session import cut_lineage
from ..plans.reference_data import literal_rows


def _null_flags(df: DataFrame):
    return [present(df, c).isNull().cast("int") for c in df.columns]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_null, pct_null, has_null) for every column, one pass, most missing first."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(present(df, c).isNull().cast("long")).alias(f"__c{i}") for i, c in enumerate(cols)])
    long = to_long(row, [(c, F.col(f"__c{i}")) for i, c in enumerate(cols)], "n_null", ids=["__n"])
    return long.select(
        "column_name", "n_null",
        (F.try_divide(F.col("n_null") * 100.0, F.col("__n"))).alias("pct_null"),
        (F.col("n_null") > 0).alias("has_null")).orderBy(F.desc("n_null"), "column_name")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).where("has_null").select("column_name", "n_null")


def row_null_histogram(df: DataFrame, top: int = 5) -> DataFrame:
    """Share of NULL cells per row -> number of rows, the ``top`` most common."""
    n_cols = len(df.columns)
    frac = reduce(lambda a, b: a + b, _null_flags(df)) / F.lit(float(n_cols))
    return (df.select(frac.alias("null_fraction")).groupBy("null_fraction")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), F.asc("null_fraction")).limit(top))


def rows_with_nulls(df: DataFrame) -> DataFrame:
    """(n_rows, n_rows_with_null, pct_rows_with_null) in one pass."""
    any_null = reduce(lambda a, b: a | b, [present(df, c).isNull() for c in df.columns])
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_null).alias("n_rows_with_null"))
    return row.select("n_rows", "n_rows_with_null",
                      F.try_divide(F.col("n_rows_with_null") * 100.0, F.col("n_rows"))
                      .alias("pct_rows_with_null"))


def value_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, value, n) for every text column; NULL values excluded."""
    cols = cols if cols is not None else columns_by_family(df, "object")
    long = (to_long(df, [(c, quoted(c).cast("string")) for c in cols], "value")
            .where(F.col("value").isNotNull()))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def row_value_counts(df: DataFrame) -> DataFrame:
    """Frequency of whole rows; rows holding any NULL are left out."""
    return df.dropna(how="any").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def group_size_topk(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The ``k`` largest groups of ``col`` (NULL keys excluded), ties by key."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


def _as_group_value(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    col = quoted(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        col = col + F.lit(0.0)  # -0.0 and 0.0 are one value, as in equality
    return col.cast("string")


def dup_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_distinct, n_duplicates) with NULL counted as one value,
    most duplicates first."""
    cols = cols if cols is not None else df.columns
    long = to_long(df, [(c, _as_group_value(df, c)) for c in cols], "value")
    per_value = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return (per_value.groupBy("column_name")
            .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
            .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))
            .orderBy(F.desc("n_duplicates"), "column_name"))


def dup_rows_pct(df: DataFrame, base_rows: int | None = None) -> DataFrame:
    """Rows belonging to a group of fully equal rows (every member counted),
    and their percentage of ``base_rows`` (default: rows of ``df``). One shuffle."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    agg = g.agg(F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c"))), F.lit(0)).alias("n_dup_rows"),
                F.coalesce(F.sum("__c"), F.lit(0)).alias("n_rows"))
    base = F.lit(base_rows) if base_rows is not None else F.col("n_rows")
    return agg.select("n_dup_rows", "n_rows",
                      F.try_divide(F.col("n_dup_rows") * 100.0, base).alias("pct_dup_rows"))


def narrow_input(df: DataFrame, cols: list[str], materialize: bool) -> DataFrame:
    """The columns a multi-pass profile reads; with ``materialize`` they are
    written once to the shared checkpoint folder so later passes read them
    instead of recomputing an expensive input plan (joins, aggregates)."""
    narrow = df.select(*[present(df, c).alias(c) for c in cols])
    return cut_lineage(narrow) if materialize else narrow


def describe_numeric(df: DataFrame, cols: list[str] | None = None,
                     probs=(0.25, 0.5, 0.75), materialize: bool = False) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per numeric column.

    One pass for the moments, then the counting rounds of :mod:`.quantiles`; set
    ``materialize`` when ``df`` is an expensive plan rather than a table scan.
    """
    cols = cols if cols is not None else columns_by_family(df, "number")
    df = narrow_input(df, cols, materialize)
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        x = quoted(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.min(finite(x)).alias(f"flo{i}"), F.max(finite(x)).alias(f"fhi{i}")]
    row = df.agg(*aggs).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    ends = {c: (row[f"flo{i}"], row[f"fhi{i}"]) for i, c in enumerate(cols)}
    q = exact_quantiles(df, cols, list(probs), counts=counts, ends=ends)
    names = ["q" + str(int(round(p * 100))) for p in probs]
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("count", T.LongType()),
                           T.StructField("mean", T.DoubleType()),
                           T.StructField("std", T.DoubleType()),
                           T.StructField("min", T.DoubleType())]
                          + [T.StructField(n, T.DoubleType()) for n in names]
                          + [T.StructField("max", T.DoubleType())])
    rows = [(c, counts[c], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"],
             *[q[c][p] for p in probs], row[f"hi{i}"]) for i, c in enumerate(cols)]
    return literal_rows(spark, rows, schema)


_SUMS = ["n", "si", "sj", "qi", "qj", "p"]


def _pair_sums(batches, k: int):
    """Sums over a partition for every pair i <= j of the ``k`` centred columns, over the
    rows where both are present: count, values, squares and products. Blocks of rows
    are added up by matrix products; a partition ends as k(k+1)/2 rows."""
    total = np.zeros((4, k, k))
    for block in batches:
        x = block.to_numpy(dtype="float64", na_value=np.nan)
        here = ~np.isnan(x)
        x, here = np.where(here, x, 0.0), here.astype("float64")
        total += [here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x]
    i, j = np.triu_indices(k)
    n, s, q, p = total
    yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "si": s[i, j], "sj": s[j, i],
                        "qi": q[i, j], "qj": q[j, i], "p": p[i, j]})


def corr_long(df: DataFrame, cols: list[str] | None = None, materialize: bool = False) -> DataFrame:
    """Pearson matrix in long form (var1, var2, i, j, r), pairwise complete,
    mirrored; diagonal 1, NULL for a constant column or one with infinities.

    Two passes: the column means, then per partition the sums of the centred
    values, squares and products of all pairs (the shifted form, numerically
    stable) as matrix products over blocks of rows. The plan has the same size
    for three columns and for a hundred; what is shuffled is k(k+1)/2 rows a partition.
    """
    cols = cols if cols is not None else columns_by_family(df, "number")
    if not cols:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, i int, j int, r double")
    df = narrow_input(df, cols, materialize)
    k = len(cols)
    xs = [quoted(c).cast("double") for c in cols]
    mean = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]).first()
    shift = [m if m is not None and math.isfinite(m) else 0.0 for m in mean]
    centred = df.select(*[(x - F.lit(m)).alias(f"c{i}") for i, (x, m) in enumerate(zip(xs, shift))])
    parts = centred.mapInPandas(lambda it: _pair_sums(it, k),
                                "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS))
    # every pair once with zero sums, so that a table without rows has its pairs too
    first = F.col("id").cast("int")
    none = (df.sparkSession.range(k).select(first.alias("i"), F.explode(F.sequence(first, F.lit(k - 1))).alias("j"))
            .select("i", "j", *[F.lit(0.0).alias(c) for c in _SUMS]))
    sums = parts.unionByName(none).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS])
    n, si, sj, qi, qj, p = (F.col(c) for c in _SUMS)
    some = F.nullif(n, F.lit(0.0))
    vi, vj = qi - si * si / some, qj - sj * sj / some
    r = F.when(n > 1, F.try_divide(p - si * sj / some, F.sqrt(vi * vj)))
    # diagonal: 1 unless constant; clamp rounding overshoot; NULL stays NULL
    r = (F.when(F.col("i") == F.col("j"), F.when((n > 1) & (vi > 0), F.lit(1.0)))
         .when(r.isNull() | F.isnan(r), F.lit(None).cast("double"))
         .when(r > 1, F.lit(1.0)).when(r < -1, F.lit(-1.0)).otherwise(r))
    both = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    cells = F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)
    names = F.array(*[F.lit(c) for c in cols])
    return (sums.select(r.alias("r"), F.explode(cells).alias("at")).select("r", "at.i", "at.j")
            .select(F.get(names, F.col("i")).alias("var1"), F.get(names, F.col("j")).alias("var2"), "i", "j", "r"))


def corr_pairs(df: DataFrame, threshold: float, cols: list[str] | None = None,
               materialize: bool = False) -> DataFrame:
    """Upper-triangle pairs with r > threshold (signed), strongest first."""
    return (corr_long(df, cols, materialize).where((F.col("i") < F.col("j")) & (F.col("r") > threshold))
            .select("var1", "var2", "r").orderBy(F.desc("r"), "var1", "var2"))


def corr_strong_matrix(df: DataFrame, threshold: float, cols: list[str] | None = None,
                       materialize: bool = False) -> DataFrame:
    """Sub-matrix of the variables having some |r| in (threshold, 1)."""
    m = corr_long(df, cols, materialize)
    strong = F.when((F.abs("r") > threshold) & (F.abs("r") < 1), 1)
    # the matrix is symmetric, so a variable's flag is the same over var1 or var2
    return (m.withColumn("f1", F.max(strong).over(Window.partitionBy("var1")))
            .withColumn("f2", F.max(strong).over(Window.partitionBy("var2")))
            .where(F.col("f1").isNotNull() & F.col("f2").isNotNull())
            .select("var1", "var2", "r"))
