"""Literal reference rows (small, fixed dimensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Betting offices (id, abbreviation, name, url, country).
# Each id equals crc32 of the abbreviation.
BETTING_OFFICES = [
    (3424915662, "WH", "William Hill", "https://www.williamhill.com/", "United Kingdom"),
    (2506957540, "IW", "Interwetten", "https://www.interwetten.com/", "Austria"),
    (3923460405, "B365", "Bet365", "https://www.bet365.com/", "United Kingdom"),
    (1179038950, "SJ", "Stan James", "https://www.stanjames.com/", "United Kingdom"),
    (1122891783, "VC", "Victor Chandler (BetVictor)", "https://www.betvictor.com/", "Gibraltar"),
    (1989802799, "BW", "Bwin", "https://www.bwin.com/", "Austria"),
    (1714678657, "GB", "Gamebookers", "https://www.gamebookers.com/", "Antigua and Barbuda"),
    (2244424266, "LB", "Ladbrokes", "https://www.ladbrokes.com/", "United Kingdom"),
    (151015397, "PS", "Pinnacle Sports", "https://www.pinnacle.com/", "Curaçao"),
    (1911832374, "BS", "Betsson", "https://www.betsson.com/", "Sweden"),
]

# Odds snapshot kinds (id, abbreviation, description).
ODDS_EVENTS = [
    (10001, "opening", "Odds at the start of the match"),
    (10002, "closing", "Odds at the end of the match"),
]

# Bookmaker codes in catalogue order; the running id is the
# 1-based position in this list.
BOOKMAKER_CODES = ["B365", "BS", "BW", "GB", "IW", "LB", "PS", "SJ", "VC", "WH"]

OFFICE_SCHEMA = T.StructType([
    T.StructField("id_betting_office", T.LongType(), False),
    T.StructField("abbr", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("id_event", T.LongType(), False),
    T.StructField("event_abb", T.StringType(), False),
    T.StructField("event_description", T.StringType(), False),
])


def literal_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Rows as a plan node (inline of literal structs over a one-row range)
    rather than an RDD scan, so the optimizer knows they are tiny: size
    estimates, broadcast decisions and constant folding all work."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    out = spark.range(1).select(F.inline(F.array(*structs)))
    return out.select(*[F.col(f.name) for f in schema.fields])


def dim_betting_office(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, BETTING_OFFICES, OFFICE_SCHEMA)


def dim_event(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, ODDS_EVENTS, EVENT_SCHEMA)


BOOKMAKER_SCHEMA = T.StructType([T.StructField("code", T.StringType(), False),
                                 T.StructField("id", T.IntegerType(), False)])


def bookmakers(spark: SparkSession) -> DataFrame:
    """(code, id) with id = 1-based catalogue position."""
    rows = [(code, i + 1) for i, code in enumerate(BOOKMAKER_CODES)]
    return literal_rows(spark, rows, BOOKMAKER_SCHEMA)
