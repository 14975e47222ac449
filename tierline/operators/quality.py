"""Consistency and key-relationship checks.

Whether a key has several values is read off the smallest and largest value and
the counts of a plain aggregate (one row per key and partition before the shuffle);
the rows are then fetched with a join against the saved key set, which adaptive
execution broadcasts or splits by measured sizes (:func:`.joins.split_join`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_edge_whitespace
from ..session import cut_lineage
from .columns import qname, quoted
from .joins import semi_join_null_safe, split_join


def _several(c, nulls_as_value: bool):
    """Aggregate: ``c`` takes more than one value (NULL being one, if so asked)."""
    differ = F.coalesce(F.min(c) != F.max(c), F.lit(False))
    if not nulls_as_value:
        return differ
    return differ | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))


def _with_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(quoted(key).isNotNull())


def fd_violation_keys(df: DataFrame, key: str, value: str, nulls_as_value: bool = True,
                      drop_null_values: bool = False) -> DataFrame:
    """Keys (non-null) mapped to more than one distinct ``value``."""
    base = _with_key(df, key)
    if drop_null_values:
        base = base.where(quoted(value).isNotNull())
    return (base.groupBy(quoted(key)).agg(_several(quoted(value), nulls_as_value).alias("__bad"))
            .where("__bad").select(quoted(key)))


def fd_violation_rows(df: DataFrame, key: str, value: str, **kw) -> DataFrame:
    """All rows whose ``key`` maps to several ``value``s."""
    return split_join(df, fd_violation_keys(df, key, value, **kw), [key], "left_semi")


def edge_whitespace_rows(df: DataFrame, id_col: str, col: str) -> DataFrame:
    return df.where(has_edge_whitespace(quoted(col))).select(quoted(id_col), quoted(col))


def casing_rows(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Rows of ids whose upper-cased ``col`` takes more than one value (NULLs ignored)."""
    bad = (_with_key(df, id_col).groupBy(quoted(id_col))
           .agg(_several(F.upper(quoted(col)), False).alias("__bad")).where("__bad").select(quoted(id_col)))
    return split_join(df, bad, [id_col], "left_semi").select(quoted(id_col), quoted(col))


def casing_rows_strict(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Rows of ids whose ``col`` differs only by letter case: one upper-cased form with several raw ones."""
    forms = (_with_key(df, id_col).groupBy(quoted(id_col), F.upper(quoted(col)).alias("__form"))
             .agg(_several(quoted(col), False).alias("__bad")))
    bad = forms.groupBy(quoted(id_col)).agg(F.max("__bad").alias("__bad")).where("__bad").select(quoted(id_col))
    return split_join(df, bad, [id_col], "left_semi").select(quoted(id_col), quoted(col))


# Names of the seven consistency checks, in report order.
CHECKS = [
    "id_to_long_name",
    "id_to_short_name",
    "id_to_fifa_id_non_null",
    "long_name_to_id",
    "edge_spaces_long_name",
    "edge_spaces_short_name",
    "short_name_casing",
]
_FLAG = {name: f"__f{i}" for i, name in enumerate(CHECKS)}


def annotate_consistency(df: DataFrame, id_col: str = "team_api_id",
                         long_col: str = "team_long_name", short_col: str = "team_short_name",
                         alt_id_col: str = "team_fifa_api_id", checks: list[str] | None = None) -> DataFrame:
    """``df`` plus one boolean column per check asked for (default: all of :data:`CHECKS`).

    The checks keyed by id share one aggregate and one join, the check keyed by
    name has its own; a key set nobody asked for is not built. Edge-space flags are per row.
    """
    checks = CHECKS if checks is None else checks
    per_key = [(id_col, {CHECKS[0]: _several(quoted(long_col), True), CHECKS[1]: _several(quoted(short_col), True),
                         CHECKS[2]: _several(quoted(alt_id_col), False),
                         CHECKS[6]: _several(F.upper(quoted(short_col)), False)}),
               (long_col, {CHECKS[3]: _several(quoted(id_col), True)})]
    out, flags = df, {}
    for key, tests in per_key:
        asked = {n: t for n, t in tests.items() if n in checks}
        if not asked:
            continue
        found = _with_key(df, key).groupBy(quoted(key)).agg(*[t.alias(_FLAG[n]) for n, t in asked.items()])
        # only violating keys are saved and joined; all others have no flag
        found = found.where(reduce(lambda a, b: a | b, [F.col(_FLAG[n]) for n in asked]))
        out = split_join(out, found, [key], "left")
        flags |= {n: F.coalesce(F.col(_FLAG[n]), F.lit(False)) for n in asked}
    flags[CHECKS[4]] = has_edge_whitespace(quoted(long_col))
    flags[CHECKS[5]] = has_edge_whitespace(quoted(short_col))
    return out.select(*[quoted(c) for c in df.columns], *[flags[n].alias(_FLAG[n]) for n in CHECKS if n in checks])


def check_consistency(df: DataFrame, id_col: str = "team_api_id",
                      long_col: str = "team_long_name", short_col: str = "team_short_name",
                      alt_id_col: str = "team_fifa_api_id", checks: list[str] | None = None) -> dict[str, DataFrame]:
    """The affected rows of each check asked for (default: all of :data:`CHECKS`), ordered by
    key and value, plus ``summary`` and the ``annotated`` rows."""
    checks = CHECKS if checks is None else checks
    ann = annotate_consistency(df, id_col, long_col, short_col, alt_id_col, checks)
    shown = {CHECKS[0]: (id_col, long_col), CHECKS[1]: (id_col, short_col), CHECKS[2]: (id_col, alt_id_col),
             CHECKS[3]: (long_col, id_col), CHECKS[4]: (id_col, long_col), CHECKS[5]: (id_col, short_col),
             CHECKS[6]: (id_col, short_col)}
    res = {}
    for n in (n for n in CHECKS if n in checks):
        by = [quoted(c) for c in shown[n]]
        whole = n in CHECKS[:4]             # these report whole rows, the others key and value
        rows = ann.where(F.col(_FLAG[n])).select(*([quoted(c) for c in df.columns] if whole else by))
        # the row's hash as last key lets the range partitioning split a frequent pair
        res[n] = rows.orderBy(*by, *([F.xxhash64(*[quoted(c) for c in df.columns])] if whole else []))
    names = [n for n in CHECKS if n in checks]
    res["summary"] = (ann.agg(*[F.count_if(F.col(_FLAG[n])).alias(n) for n in names])
                      .unpivot([], names, "check_name", "n_affected"))
    res["annotated"] = ann
    return res


def fd_violations(df: DataFrame, **kw) -> DataFrame:
    """Rows breaking any of the four functional dependencies, one row per
    (check, row), tagged by ``check_name``; one pass over the annotated frame."""
    ann = annotate_consistency(df, checks=CHECKS[:4], **kw)
    names = F.array(*[F.when(F.col(_FLAG[n]), F.lit(n)) for n in CHECKS[:4]])
    return (ann.select(F.explode(F.filter(names, lambda x: x.isNotNull())).alias("check_name"),
                       *[quoted(c) for c in df.columns]))


def whitespace_check(df: DataFrame, id_col: str = "team_api_id",
                     cols=("team_long_name", "team_short_name")) -> DataFrame:
    parts = [edge_whitespace_rows(df, id_col, c)
             .select(F.lit(c).alias("column_name"), quoted(id_col), quoted(c).alias("value")) for c in cols]
    return reduce(DataFrame.unionByName, parts)


def key_checks(fk: DataFrame, fk_col: str, pk: DataFrame, pk_col: str) -> DataFrame:
    """Uniqueness of both key columns, equality of their value sets, orphan and
    unreferenced counts, all from one union + groupBy on the key."""
    u = (fk.select(quoted(fk_col).alias("k"), F.lit(1).alias("in_fk"), F.lit(0).alias("in_pk"))
         .unionByName(pk.select(quoted(pk_col).alias("k"), F.lit(0).alias("in_fk"), F.lit(1).alias("in_pk"))))
    g = u.groupBy("k").agg(F.sum("in_fk").alias("n_fk"), F.sum("in_pk").alias("n_pk"))
    return g.agg(
        F.coalesce(F.max("n_fk") <= 1, F.lit(True)).alias("fk_is_unique"),
        F.coalesce(F.max("n_pk") <= 1, F.lit(True)).alias("pk_is_unique"),
        (F.count_if((F.col("n_fk") == 0) | (F.col("n_pk") == 0)) == 0).alias("key_sets_equal"),
        F.coalesce(F.sum(F.when(F.col("n_pk") == 0, F.col("n_fk"))), F.lit(0)).alias("n_fk_orphans"),
        F.coalesce(F.sum(F.when(F.col("n_fk") == 0, F.col("n_pk"))), F.lit(0)).alias("n_pk_unreferenced"))


def orphan_keys(fk: DataFrame, fk_col: str, pk: DataFrame, pk_col: str) -> DataFrame:
    """(side, key): foreign-key rows without a match, and unreferenced key rows.

    The right side of either anti join is a set of keys, made on the map side and saved first: a key
    that a third of the rows share is one row there, and on the left Spark can split it."""
    of_fk, of_pk = fk.select(quoted(fk_col).alias("key")), pk.select(quoted(pk_col).alias("key"))
    fk_keys, pk_keys = (cut_lineage(k.distinct(), "keys") for k in (of_fk, of_pk))
    # a NULL key on both sides is a match, as in key_checks
    orphans = of_fk.join(pk_keys, of_fk["key"].eqNullSafe(pk_keys["key"]), "left_anti")
    unref = of_pk.join(fk_keys, of_pk["key"].eqNullSafe(fk_keys["key"]), "left_anti")
    return (orphans.select(F.lit("fk_orphan").alias("side"), "key")
            .unionByName(unref.select(F.lit("pk_unreferenced").alias("side"), "key")))


def join_one_to_one(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Inner join that first proves both key columns unique (one job over both
    sides); raises ValueError naming the side(s) with a repeated key."""
    keys = (left.select(F.lit("left").alias("side"), quoted(left_on).alias("k"))
            .unionByName(right.select(F.lit("right").alias("side"), quoted(right_on).alias("k"))))
    bad = (keys.groupBy("side", "k").count().where(F.col("count") > 1)
           .groupBy("side").count().collect())  # at most two rows
    if bad:
        sides = sorted(r.side for r in bad)
        raise ValueError(f"join is not one-to-one: repeated keys on {' and '.join(sides)} side")
    if left_on == right_on:
        return left.join(right, left_on, "inner")
    return left.join(right, left[qname(left_on)] == right[qname(right_on)], "inner")


def duplicate_rows(df: DataFrame, subset: list[str] | None = None, sort: bool = False) -> DataFrame:
    """Every member of a group of rows equal on ``subset`` (all columns by
    default; NULLs equal), optionally sorted by those columns.

    The repeated keys come from one aggregate, saved once, and the rows from a
    semi join against them. The sort's last key is a hash of the whole row, so
    that a large group of different rows is dealt to several sort tasks."""
    cols = subset or df.columns
    keys = (df.groupBy(*[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 1).select(*[quoted(c) for c in cols]))
    out = semi_join_null_safe(df, keys, cols)
    if not sort:
        return out
    return out.orderBy(*[quoted(c) for c in cols], F.xxhash64(*[quoted(c) for c in df.columns]))
