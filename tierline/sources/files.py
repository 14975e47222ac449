"""File discovery and scans (CSV volumes, parquet tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The driver-provided test tables.
TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in (names or TABLE_NAMES)}


def _strip_scheme(path: str) -> str:
    path = path.split(":", 1)[1] if ":" in path.split("/", 1)[0] else path
    while path.startswith("//"):
        path = path[1:]
    return path.rstrip("/")


def list_files(spark: SparkSession, folder: str, extension: str = ".csv") -> dict[str, str]:
    """Lower-cased entry name -> path of the entries of ``folder`` with this extension (any case).

    An entry is a file, or a folder of part files as Spark writes them. The
    folder is resolved by its own file system, so relative and dotted paths list
    like absolute ones; part files are reduced to entries before anything is collected.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    root = system.makeQualified(root)
    if not system.exists(root):
        raise RuntimeError(f"cannot list {folder}: no such folder")
    root = root.toString().rstrip("/")
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    files = (spark.read.format("binaryFile").options(pathGlobFilter=f"*{any_case}", recursiveFileLookup=True)
             .load(root).select(F.regexp_replace("path", "^[A-Za-z0-9+.-]+:(//[^/]*)?", "").alias("path")))
    below = F.substring("path", len(_strip_scheme(root)) + 2, 2**31 - 1)
    entries = files.select(F.substring_index(below, "/", 1).alias("entry")).distinct()
    names = [r["entry"] for r in entries.collect() if r["entry"].lower().endswith(extension.lower())]
    return {name.lower(): f"{root}/{name}" for name in sorted(names)}


def read_csv(spark: SparkSession, path: str, semicolon: bool = False,
             infer_schema: bool = True, schema=None) -> DataFrame:
    """CSV with a header row. Types are inferred from all rows (one more pass over
    the file), or given as ``schema``."""
    options = {"header": True, "sep": ";" if semicolon else ","}
    if schema is not None:
        return spark.read.schema(schema).options(**options).csv(path)
    return spark.read.options(inferSchema=infer_schema, **options).csv(path)


def read_named_csv(spark: SparkSession, files: dict[str, str], name: str,
                   semicolon: bool = False) -> DataFrame:
    """Read ``<name>.csv`` from a listing made by :func:`list_files`."""
    key = f"{name}.csv".lower()
    if key not in files:
        raise FileNotFoundError(f"{name}.csv not found; found: {sorted(files)}")
    return read_csv(spark, files[key], semicolon=semicolon)
