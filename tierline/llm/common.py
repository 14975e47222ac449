"""Helpers that the text operators share: reading, slicing batches, ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

SLICE_BYTES = 4 << 20           # text held as Python objects at one time in a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the two columns the operators use; others are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text (a null id as the empty text), modulo ``modulus``."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % F.lit(modulus)


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of at most ``limit`` bytes, one text at least."""
    lo = size = 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def scan(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Map whole texts in bounded slices.

    ``df``'s last column is the text; ``make()`` runs once per task and returns
    ``work(columns, texts) -> dict of columns``; ``columns`` holds the other
    columns as lists, ``texts`` the UTF-8 bytes (null: empty).
    """
    struct: StructType = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(struct)
        work = make()
        for columns, texts in _sliced(batches):
            made = work(columns, texts)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, f.type)
                 for x, f in ((made[f.name], f) for f in out)], schema=out)

    return df.mapInArrow(run, struct)


def fold(df: DataFrame, make: Callable[[], tuple[Callable, Callable]], schema: str) -> DataFrame:
    """Fold whole texts within a task.

    ``make()`` runs once per task and returns ``add(columns, texts)``, true if what is
    held should go out now, and ``flush() -> dict of columns``.
    """
    struct: StructType = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(struct)
        add, flush = make()
        held = False

        def batch_of():
            made = flush()
            return pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in ((made[f.name], f) for f in out)], schema=out)

        for columns, texts in _sliced(batches):
            held = True
            if add(columns, texts):
                yield batch_of()
                held = False
        if held:
            yield batch_of()

    return df.mapInArrow(run, struct)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, one text at a time (null: empty)."""
    return (x.as_py() or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(other columns as lists, the last column as UTF-8 bytes) of bounded slices."""
    for batch in batches:
        *rest, last = batch.columns
        last = last.cast(pa.large_binary() if pa.types.is_large_string(last.type) else pa.binary())
        lengths = [range(n or 0) for n in pc.binary_length(last).to_pylist()]
        for lo, hi in slices(lengths):
            texts = [x or b"" for x in last.slice(lo, hi - lo).to_pylist()]
            yield [c.slice(lo, hi - lo).to_pylist() for c in rest], texts


def ship(df: DataFrame, value):
    """A read-only value of bounded size for all tasks (``.value`` in the task)."""
    return df.sparkSession.sparkContext.broadcast(value)
