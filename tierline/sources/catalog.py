"""Managed tables, views and audited saves."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.reference_data import literal_rows
from .files import list_files, read_named_csv


_VERSION = "__v-"                # between a table's folder and what tells its versions apart


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return name


def save_table(df: DataFrame, database: str, name: str, fmt: str = "parquet",
               path: str | None = None, options: dict[str, str] | None = None) -> str:
    """Overwrite ``database.name`` with ``df`` (CREATE OR REPLACE TABLE ... AS SELECT).

    The old table stays until the new one stands: rows are written to a folder of their own beside
    the old ones, then the catalog's entry is moved there in one step. A write that fails leaves the table as it
    was, readers keep the files they have begun to read, and ``df`` may read the table it replaces. Where columns
    or format differ, the entry cannot be moved: a second one is made first, then takes the
    name. Read such tables by name, not by folder; older folders stay (the folder's retention is not
    the library's). Delta tables replace themselves in one step. ``options`` are the writer's.
    """
    spark = df.sparkSession
    qualified = f"`{database}`.`{name}`"
    if fmt == "delta" or not spark.catalog.tableExists(qualified):
        writer = df.write.mode("overwrite").format(fmt).options(**(options or {}))
        if fmt == "delta":
            writer = writer.option("overwriteSchema", "true")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(qualified)
        return qualified
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect()
             if r.col_name in ("Provider", "Location")}
    version = f"{(path or facts['Location']).rstrip('/').split(_VERSION)[0]}{_VERSION}{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).options(**(options or {})).save(version)
    if facts.get("Provider", "").lower() == fmt.lower() and spark.table(qualified).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{version}'")
        spark.catalog.refreshTable(qualified)
        return qualified
    following = f"{name}_next_{version[-12:]}"
    spark.catalog.createTable(f"{database}.{following}", path=version, source=fmt, schema=df.schema)
    spark.sql(f"DROP TABLE {qualified}")
    spark.sql(f"ALTER TABLE `{database}`.`{following}` RENAME TO {qualified}")
    return qualified


def _count_tables(spark: SparkSession, qualified_names: dict[str, str]) -> DataFrame:
    """One job counting every saved table (re-read from storage, not from the plan)."""
    parts = [spark.table(q).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(label).alias("table_name"), "n_rows")
             for label, q in qualified_names.items()]
    return reduce(DataFrame.unionByName, parts)


def save_and_audit(spark: SparkSession, frames: dict[str, DataFrame], database: str,
                   fmt: str = "parquet", location: str | None = None) -> DataFrame:
    """Save each frame as ``database.<name>`` and report rows read back from storage."""
    ensure_database(spark, database, location)
    saved = {}
    for name, df in frames.items():
        path = f"{location.rstrip('/')}/{name}" if location else None
        saved[name] = save_table(df, database, name, fmt, path)
    return _count_tables(spark, saved)


_LOAD_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
])


def bronze_load(spark: SparkSession, folder: str, names: list[str], database: str = "bronze",
                fmt: str = "parquet", location: str | None = None,
                semicolon: bool = False) -> DataFrame:
    """Load every ``<name>.csv`` of ``folder`` into ``database``.

    A table without a file, or with one that is no table, is reported with status
    ``skipped`` and the reason, and the load continues; a failing cluster ends it. Returns (table_name, status, n_rows).
    """
    files = list_files(spark, folder, ".csv")
    ensure_database(spark, database, location)
    saved, skipped = {}, []
    for name in names:
        try:
            df = read_named_csv(spark, files, name, semicolon=semicolon)
            path = f"{location.rstrip('/')}/{name}" if location else None
            saved[name] = save_table(df, database, name, fmt, path)
        except (FileNotFoundError, AnalysisException) as exc:  # absent or not a table; other failures end the load
            skipped.append((name, f"skipped: {type(exc).__name__}: {exc}", None))
    parts = []
    if saved:
        parts.append(_count_tables(spark, saved).select(
            "table_name", F.lit("loaded").alias("status"), "n_rows"))
    if skipped:
        parts.append(literal_rows(spark, skipped, _LOAD_SCHEMA))
    if not parts:
        return spark.createDataFrame([], _LOAD_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def create_view(df: DataFrame, name: str) -> str:
    """Session-scoped view (``CREATE OR REPLACE TEMP VIEW``)."""
    df.createOrReplaceTempView(name)
    return name


def create_persistent_view(spark: SparkSession, name: str, sql_text: str) -> str:
    """``CREATE OR REPLACE VIEW`` over catalog tables; the plan is stored, not the data."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql_text}")
    return name


def rows_to_json(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """One JSON record per row (all columns), next to its key columns."""
    return df.select(*key_cols, F.to_json(F.struct(*df.columns)).alias("json"))


def scan_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns) for every table, in one job.

    Row counts of parquet scans come from footers; the column count is a
    plan-time fact of the schema.
    """
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows",
                     F.lit(len(df.columns)).alias("n_columns"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, n_rows, n_columns) for every table of ``database``:
    the catalog lists the tables, one job counts them all."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary
             and (t.tableType or "").upper() != "VIEW"]
    if not names:
        return spark.createDataFrame([], "table_name string, n_rows long, n_columns int")
    return scan_profile({n: spark.table(f"`{database}`.`{n}`") for n in sorted(names)})
