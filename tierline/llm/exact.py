"""Exact dedup by an extendible-hash index on shared files; SQL functions only.

Every text is normalised (runs of white space become one blank) and hashed. A first pass
writes one line a row - id, hash, digest, length - and sums rows and bytes by hash.

The directory is made from these sums. It starts as one bucket of all hashes, addressed
by no bits. A bucket that is overfull (more than ``BUCKET_ENTRIES``, counting one for a row and one
for each ``ENTRY_BYTES`` of its text) and holds two hashes or more is split by its next bit; when its bits are as
many as the directory's, the directory doubles. Others stay whole, so buckets differ in
local depth. Splits are worked out some bits at a time: sums by address, rolled up to
every shorter prefix, tell which prefixes split; only what is still overfull is read again.

Entries - hash, id and the text itself - then go to owner tasks. An owner has a range of
buckets, and so of hashes, of about one bucket's size. Within a bucket, entries with the same hash form a chain; its texts
are told apart by their bytes (the owner groups by the text itself), so a collision never
merges two texts. The owner writes each text's line of the index: its bucket, hash, digest, smallest id and number of rows.
Rows then look up their line.

A hash with more than a quarter of a bucket's entries (and 1 / ``HOT`` of all) in copies is summed in
``SALTS`` parts before its owner puts these together: a text that a third of all rows share
is a few entries there. Broadcast are hot hashes (fewer than ``HOT``, 8 bytes each) and the directory: buckets
grow with the input rather than be more than about ``MAX_BUCKETS`` (30 bytes each).

Defined cases: a null text equals the empty one; of rows with equal texts those
with the smallest doc_id stay (rows that share that id all stay: they are one
document); rows without doc_id are never the one that stays unless all of a
group lack it (then keep_id is null and all stay); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text

BUCKET_ENTRIES, ENTRY_BYTES = 16_384, 1024
MAX_BUCKETS = 1 << 18
MAX_DEPTH, MORE_BITS = 63, 8
HOT, SALTS = 100_000, 8


def normalised(text: Column) -> Column:
    """Each run of white space as one blank. Only runs that need it are matched:
    a single blank, by far the most frequent, is left alone."""
    space = r"[\x20\x09-\x0D]*"
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"\x20{{2,}}{space}|\x20?[\x09-\x0D]{space}", " ")


def address(h: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a hash."""
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def directory(hashes: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """bucket, depth, prefix, weight, owner of every bucket that holds something, from (h, weight): each hash once.

    ``depth`` is the local depth, ``prefix`` the leading bits; buckets are numbered in the order of their hashes,
    owners have consecutive ones. A written table.
    """
    total = hashes.agg(F.sum("weight")).first()[0] or 0
    capacity = max(bucket_entries, total / MAX_BUCKETS)
    known, depth = 0, min(MAX_DEPTH, 2 + max(0, ceil(log2(max(1, total / capacity)))))     # an even hash needs two bits less
    closed, overfull = [], hashes
    while True:
        slots = overfull.groupBy(address(F.col("h"), depth).alias("slot")).agg(
            F.sum("weight").alias("weight"), F.min("h").alias("first"), F.max("h").alias("last"))
        nodes = (slots.select("*", F.explode(F.sequence(F.lit(known), F.lit(depth))).alias("depth"))
                 .withColumn("prefix", F.expr(f"shiftrightunsigned(slot, {depth} - depth)"))
                 .groupBy("depth", "prefix").agg(F.sum("weight").alias("weight"), F.min("first").alias("first"), F.max("last").alias("last")))
        nodes = cut_lineage(nodes.withColumn("splits", (F.col("weight") > capacity) & (F.col("first") != F.col("last"))
                                             & (F.col("depth") < MAX_DEPTH)).drop("first", "last"), "hash-splits")
        above = nodes.where("splits").select((F.col("depth") + 1).alias("depth"), F.explode(F.array(
            F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
        leaves = nodes.where("not splits")
        closed += [leaves.where("depth = 0"), leaves.join(above, ["depth", "prefix"], "left_semi")]
        still = nodes.where((F.col("depth") == depth) & F.col("splits")).select(F.col("prefix").alias("slot"))
        if still.isEmpty():
            break
        overfull = hashes.join(F.broadcast(still), address(hashes["h"], depth) == still["slot"], "left_semi")    # total / capacity rows at most
        known, depth = depth, min(MAX_DEPTH, depth + MORE_BITS)
    start = F.expr("shiftleft(prefix, 64 - depth)").bitwiseXOR(F.lit(-1 << 63))             # in the order of unsigned numbers
    in_order = Window.orderBy(start)                                                        # of about 2 * MAX_BUCKETS rows at most
    before = F.coalesce(F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cut_lineage(reduce(DataFrame.unionByName, closed).select(
        F.row_number().over(in_order).alias("bucket"), "depth", "prefix", "weight", F.floor(before / capacity).alias("owner")), "hash-directory")


def placed(entries: DataFrame, buckets: DataFrame) -> DataFrame:
    """``entries`` with the bucket of their hash and its owner. A hash has one prefix in the directory, of one of its depths."""
    depths = [r[0] for r in buckets.select("depth").distinct().orderBy("depth").collect()]      # 64 at most
    at = [F.struct(F.lit(d).alias("depth"), address(F.col("h"), d).alias("prefix")) for d in depths]
    found = F.broadcast(buckets.select("depth", "prefix", "bucket", "owner"))
    return (entries.select("*", F.explode(F.array(*at) if at else F.expr("cast(array() as array<struct<depth:int,prefix:long>>)")).alias("at"))
            .select("*", "at.depth", "at.prefix").drop("at").join(found, ["depth", "prefix"]).drop("depth", "prefix"))


def build_index(base: DataFrame, rows: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """bucket, h, digest, keep_id, group_size of every distinct text, out of the owners. A written table.

    ``base``: doc_id, text, h; ``rows``: doc_id, h, n_bytes.
    """
    weight = F.count("*") + F.floor(F.sum("n_bytes") / ENTRY_BYTES)
    hashes = cut_lineage(rows.groupBy("h").agg(F.count("*").alias("n"), weight.alias("weight")), "hash-sums")
    total = hashes.agg(F.sum("weight")).first()[0] or 0
    is_hot = (F.col("n") > 1) & (F.col("weight") > max(bucket_entries / 4, total / HOT))
    hot = hashes.where(is_hot).select("h")
    summed = F.ceil(F.col("weight") / F.col("n") * SALTS)
    buckets = directory(hashes.select("h", F.when(is_hot, F.least(summed, F.col("weight"))).otherwise(F.col("weight")).alias("weight")), bucket_entries)

    entries = base.join(F.broadcast(hot), "h", "left_anti").select("h", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    if not hot.isEmpty():
        parts = base.join(F.broadcast(hot), "h", "left_semi").groupBy("h", "text", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("part"))
        entries = entries.unionByName(parts.agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).drop("part"))
    chains = placed(entries, buckets).repartition("owner").groupBy("owner", "bucket", "h", "text")
    texts = chains.agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return cut_lineage(texts.select("bucket", "h", digest(F.col("text")).alias("digest"), "keep_id", "group_size")
                       .sortWithinPartitions("bucket", "h"), "hash-index")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def find_duplicates(docs: DataFrame, hash_fn: Callable[[Column], Column] = F.xxhash64,
                    bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    base = id_and_text(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    base = base.withColumn("h", hash_fn(F.col("text")))
    rows = cut_lineage(base.select("doc_id", "h", digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes")), "hash-rows")
    index = build_index(base, rows, bucket_entries)
    return rows.join(index, ["h", "digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def unique_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    dropped = (find_duplicates(docs).where("not kept")
               .select(F.col("doc_id").alias("dropped_id"), F.col("text_sha256").alias("dropped_text")).distinct())
    same_text = F.sha2(F.encode(normalised(docs["text"]), "UTF-8"), 256) == dropped["dropped_text"]
    return docs.join(dropped, docs["doc_id"].cast("long").eqNullSafe(dropped["dropped_id"]) & same_text, "left_anti")
