"""Join helpers: joins that frequent keys do not hold up, NULL-safe semi joins,
suffixing of clashing columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..session import cut_lineage
from .columns import qname, quoted


def join_with_suffixes(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                       how: str = "inner", suffixes=("_left", "_right")) -> DataFrame:
    """Equi-join where columns present on both sides get ``suffixes``; the rest keep their names."""
    clash = set(left.columns) & set(right.columns)
    l = left.select(*[quoted(c).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    r = right.select(*[quoted(c).alias(c + suffixes[1] if c in clash else c) for c in right.columns])
    lk = left_on + suffixes[0] if left_on in clash else left_on
    rk = right_on + suffixes[1] if right_on in clash else right_on
    return l.join(r, l[qname(lk)] == r[qname(rk)], how)


def semi_join_null_safe(df: DataFrame, keys: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``cols`` equal (NULL-safe) a row of ``keys``; the keys are saved
    first, as in :func:`split_join`."""
    k = cut_lineage(keys.select(*[quoted(c).alias(f"__k_{i}") for i, c in enumerate(cols)]))
    cond = reduce(lambda a, b: a & b,
                  [df[qname(c)].eqNullSafe(k[f"__k_{i}"]) for i, c in enumerate(cols)])
    return df.join(k, cond, "left_semi")


def split_join(big: DataFrame, lookup: DataFrame, on: list[str], how: str, save: bool = True) -> DataFrame:
    """``big.join(lookup, on, how)`` in which no key is the load of one task.

    Adaptive execution splits a partition that a frequent key (or the NULL key of
    an outer join) makes large, but only where each side is a shuffle of its own; an
    aggregate in the same plan already has the join's partitioning and forbids it. So the
    lookup is written once to the shared folder and joined from there. It is the
    same plan at every size: the planner broadcasts the lookup by the size of its files
    or splits the big side by the sizes it measures, for any number of frequent keys.
    ``save=False`` is for a large lookup that must be dealt out anew for the join anyway (an aggregate
    by more keys, say): its shuffle is one of its own, and writing it first would only cost another copy.
    """
    return big.join(cut_lineage(lookup) if save else lookup, on, how)
