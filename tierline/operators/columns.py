"""Plan-time column discovery (names and types only; no data is read)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FAMILIES = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "object": (T.StringType,),
    "bool": (T.BooleanType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
}
_FAMILIES["number"] = _FAMILIES["int"] + _FAMILIES["float"]


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual name of the column equal to ``name`` ignoring case, or None."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def columns_by_family(df: DataFrame, *families: str) -> list[str]:
    """Columns whose type belongs to any of the families
    (int, float, number, object, bool, datetime), in schema order."""
    types = tuple(t for fam in families for t in _FAMILIES[fam])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def discover_odds_triples(columns: list[str]) -> list[tuple[str, str, str, str]]:
    """(PREFIX, home_col, draw_col, away_col) of every odds family, in schema order.

    Names are compared without case, blanks and underscores. A family is an
    alphanumeric prefix with an ``h``, a ``d`` and an ``a`` column; only within a
    family must each of the three be one column.
    """
    named = [("".join(ch for ch in c.lower() if ch not in " _"), c) for c in columns]
    prefixes = dict.fromkeys(n[:-1] for n, _ in named if n[-1:] in tuple("hda") and re.fullmatch("[a-z0-9]+", n[:-1]))
    triples = []
    for prefix in prefixes:
        family = [[c for n, c in named if n == prefix + end] for end in "hda"]
        if not all(family):
            continue
        twice = [same for same in family if len(same) > 1]
        if twice:
            raise ValueError(f"several columns are the same odds column of {prefix!r}: {twice}")
        triples.append((prefix.upper(), *(same[0] for same in family)))
    return triples


def present(df: DataFrame, name: str):
    """The column with NaN, a missing value like NULL, as NULL."""
    c = quoted(name)
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c


def suffix_columns(columns: list[str], suffixes=("A", "D", "H")) -> list[str]:
    """Columns whose name ends with one of ``suffixes`` (case-sensitive)."""
    return [c for c in columns if c.endswith(tuple(suffixes))]


def qname(name: str) -> str:
    """``name`` as a quoted identifier (dots, spaces and backticks taken literally)."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str):
    """Column reference that takes ``name`` literally (dots, spaces)."""
    return F.col(qname(name))


def to_long(df: DataFrame, items: list, value_name: str, ids: list[str] | None = None,
            name_col: str = "column_name") -> DataFrame:
    """Unpivot ``items`` = [(name, Column), ...] into (ids..., name_col, value_name).

    The values are unpivoted under positional aliases and the names mapped back
    afterwards, so any column name (dots, spaces, backticks) is safe.
    """
    ids = ids or []
    aliases = [f"__v{i}" for i in range(len(items))]
    wide = df.select(*[quoted(i) for i in ids], *[e.alias(a) for (_, e), a in zip(items, aliases)])
    long = wide.unpivot(ids, aliases, "__k", value_name)
    names = F.create_map(*[x for a, (n, _) in zip(aliases, items) for x in (F.lit(a), F.lit(n))])
    return long.select(*[quoted(i) for i in ids], names[F.col("__k")].alias(name_col), value_name)
