"""Cleaning: drop nulls, fill with means, dedupe, parse dates, repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import columns_by_family, present, quoted


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without NULL in ``subset`` (all columns when omitted)."""
    return df.dropna(how="any", subset=subset)


def fill_with_mean(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NULL and NaN of numeric ``cols`` by the column mean (both skipped).

    The means are one aggregate row (one value per column, a bounded plan-time
    fact), applied as literals so the fill stays a narrow projection. Filled
    columns become DOUBLE.
    """
    cols = cols if cols is not None else columns_by_family(df, "number")
    if not cols:
        return df
    row = df.agg(*[F.avg(present(df, c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    out = []
    for c in df.columns:
        if c in cols:
            fill = F.lit(means[c]).cast("double")
            out.append(F.coalesce(present(df, c).cast("double"), fill).alias(c))
        else:
            out.append(quoted(c))
    return df.select(*out)


def drop_duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep one row per distinct value of ``subset`` (all columns by default);
    a hash aggregate with map-side combine, so a hot row collapses before the shuffle."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def dedupe_keep_min_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per group of rows equal on every column but ``id_col`` (NULLs
    equal), keeping the lowest non-null id (NULL only when all are NULL).

    Equivalent to ``row_number() over (partition by rest order by id asc nulls
    last) = 1`` but planned as ``groupBy(rest).min(id)``: partial aggregation
    shrinks each group before the shuffle, and a hot group is never buffered in
    one window partition. Without ``id_col`` it is a plain distinct.
    """
    if id_col not in df.columns:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != id_col]
    if not rest:
        return df.agg(F.min(id_col).alias(id_col))
    return (df.groupBy(*[quoted(c) for c in rest]).agg(F.min(quoted(id_col)).alias(id_col))
            .select(*[quoted(c) for c in df.columns]))


def parse_timestamp(df: DataFrame, col: str, target: str | None = None) -> DataFrame:
    """Text -> TIMESTAMP; unparsable text becomes NULL (no ANSI error)."""
    return df.withColumn(target or col, F.try_to_timestamp(quoted(col).cast("string")))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Repeatable sample of ``min(n, rows)`` rows: the ``n`` smallest md5(key).

    Planned as a top-k (per-partition heaps, then one merge of n rows per
    partition), not a global sort. An empty input gives an empty result.
    """
    return (df.withColumn("__h", F.md5(quoted(key).cast("string")))
            .orderBy("__h", quoted(key)).limit(n).drop("__h"))
