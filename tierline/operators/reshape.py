"""Wide <-> long reshaping: melt, pivot, exploded structs, array positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import quoted


def melt(df: DataFrame, ids: list[str], values: list[str], var_name: str,
         value_name: str) -> DataFrame:
    """One row per (id, value column); NULL values are kept."""
    return df.unpivot(ids, values, var_name, value_name)


def split_last_char(col: Column) -> tuple[Column, Column]:
    """(all but the last character, last character)."""
    return F.substring(col, F.lit(1), F.length(col) - 1), F.right(col, F.lit(1))


def pivot_mean(df: DataFrame, index: list[str], column: str, value: str,
               pivot_values: list[str]) -> DataFrame:
    """Mean of ``value`` per index row and pivot value; rows whose pivoted
    cells are all NULL are dropped.

    Written as one conditional average per pivot value: a single aggregate
    with one shuffle, combined map-side (``groupBy().pivot()`` plans a second
    aggregation and shuffle), and no job to discover the pivot values."""
    wide = df.groupBy(*index).agg(*[F.avg(F.when(F.col(column) == v, F.col(value))).alias(v)
                                    for v in pivot_values])
    any_value = reduce(lambda a, b: a | b, [quoted(v).isNotNull() for v in pivot_values])
    return wide.where(any_value)
