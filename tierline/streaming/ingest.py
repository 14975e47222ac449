"""Incremental ingestion of match files as they land in a folder.

The batch bronze -> silver -> events_long path re-reads every file on each run;
here the same transformations run as Structured Streaming queries over a file
source, so each file is processed once:

* ``events_long_stream``: silver typing + odds explode, stateless (append).
* ``dim_period_stream``: new calendar days only. Each micro-batch reduces its
  rows to distinct days (map-side combined, so a day holding most rows costs
  one row per partition), drops days already in the target table (NULL-safe
  anti join) and appends the rest. The target table is the only state and is
  bounded by the calendar; replaying a batch after a failure adds nothing.

Sinks are parquet files with a checkpoint in the shared checkpoint folder, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import gold, silver


def landing_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of ``folder``; streams need the schema up front (no inference)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def events_long_stream(matches: DataFrame) -> DataFrame:
    """Bronze match rows -> (id_match, id_league, date_key, office, odds)."""
    ev = silver.events_long(silver.silver_match(matches))
    if ev is None:
        raise ValueError("no home/draw/away odds columns in the match stream")
    return ev


def new_periods_writer(target: str):
    """foreachBatch function appending the batch's unseen days to ``target``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = silver.silver_match(batch).select(F.to_date("match_date").alias("date")).distinct()
        try:
            known = spark.read.parquet(target).select(F.col("date").alias("known"))
            days = days.join(known, days["date"].eqNullSafe(known["known"]), "left_anti")
        except AnalysisException as missing:                   # before the first batch there is no target
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        gold.period_rows(days).write.mode("append").parquet(target)

    return write


def _finish(query):
    """Wait for an available-now query to end; raise what ended it otherwise."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")
    return query


def dim_period_stream(matches: DataFrame, target: str, checkpoint: str):
    """Maintain the calendar dimension at ``target`` from a match stream
    (match dates; odds rows share the same days, plus the all-NULL day)."""
    query = (matches.writeStream.foreachBatch(new_periods_writer(target))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return _finish(query)


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet"):
    """Process everything that has landed, then stop (incremental batch run)."""
    query = (stream.writeStream.format(fmt).outputMode("append")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    return _finish(query)
