"""Line-up identity: an order-insensitive hash of the players on one side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lineup_hash(players: Column, id_match: Column, local: Column, min_known: int = 3) -> Column:
    """SHA-256 of the sorted non-zero player ids joined by ``|`` when at least
    ``min_known`` are known; otherwise SHA-256 of ``id_match|local``."""
    known = F.array_sort(F.filter(players, lambda x: x != 0))
    by_players = F.sha2(F.array_join(F.transform(known, lambda x: x.cast("string")), "|"), 256)
    by_match = F.sha2(F.concat_ws("|", id_match.cast("string"), local.cast("string")), 256)
    return F.when(F.size(known) >= min_known, by_players).otherwise(by_match)


def pack_sql(name: str) -> str:
    """SQL of the id in column ``name`` as bytes, for shuffles and scratch files: a hash takes
    33 bytes instead of 64. A first byte tells hashes from other texts, so different ids stay different."""
    is_hash = f"length({name}) = 64 AND translate({name}, '0123456789abcdef', '') = ''"
    return f"CASE WHEN {is_hash} THEN concat(X'01', unhex({name})) ELSE concat(X'00', CAST({name} AS BINARY)) END"


def unpack_sql(name: str) -> str:
    """SQL of the id that :func:`pack_sql` packed."""
    rest = f"substring({name}, 2)"
    return f"CASE WHEN substring({name}, 1, 1) = X'01' THEN lower(hex({rest})) ELSE CAST({rest} AS STRING) END"


def pack_id(name: str = "id_lineup") -> Column:
    return F.expr(pack_sql(name)).alias("packed")


def unpack_id(name: str = "packed") -> Column:
    return F.expr(unpack_sql(name)).alias("id_lineup")
