"""Long repeated strings by difference-cover suffix sorting, one bucket at a time.

Which strings of ``length`` bytes occur at two places or more? Positions p of a text
with p mod v in a difference cover of v are its cover sample: for any two
places i, j some offset below v puts both into the sample. So two equal strings
of ``length`` bytes hold, at the same offset, sample positions with the same
``name`` - the hash of the next length - v + 1 bytes.

Texts lie in blocks of a bounded size. In each round every block sends sorted names to the
owners of the name buckets (an owner sorts one bucket, in memory bounded by the
number of buckets, which follows the input) and gets back a few bits a name:

1. *cover sample*: which samples' names occur again. All others are settled: no
   string around them repeats.
2. *ranks*: the samples left send their name with the name of their whole
   surroundings, all strings of ``length`` that contain the sample at its offset.
   Equal surroundings are a tie as long as it matters, and settle all those
   strings at once. Where a name has several surroundings, one sample of each
   goes on.
3. *suffixes*: only the suffixes around those samples, by the names of their first
   ``length`` bytes, are sorted bucket by bucket.

A block sends a name twice at most, however often it occurs, so a passage that a
third of all texts share gives its owner two entries a block. Sample names are
32 bits below the bucket's (a chance match only goes on to the next round). What
decides, the surroundings and the suffixes, has names of 96 bits, 64 of one hash and 32
of another: the odds of any chance match over n names are n*n/2**97.

Blocks are written once, bucketed by block, into the shared folder; each round reads them
without a shuffle of the texts, and its answers are written before the next.

Defined cases: null and empty texts have no bytes and nothing is removed; repeated
rows (also of one doc_id) are places of their own, so their texts repeat; texts under
``length`` bytes keep everything; rows without doc_id take part; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import gc
from hashlib import sha256
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_scratch
from .common import id_and_text, slices

LENGTH = 200
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20          # input bytes for each name bucket
SLICE_BYTES = 512 << 10

_RNG = np.random.default_rng(7)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)              # two hashes: odd bases, byte values of their own
_BYTES = [_RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in _BASES]


def difference_cover(q: int) -> np.ndarray:
    """Singer's difference set of q*q+q+1 for a prime q: exponents of a generator of
    GF(q^3) whose power has no square term; every difference occurs exactly once."""
    v = q * q + q + 1
    for code in range(q ** 3):
        a, b, c = code // q // q, code // q % q, code % q            # x^3 = a x^2 + b x + c
        x, found = (1, 0, 0), []
        for i in range(q ** 3 - 1):
            if x[2] == 0:
                found.append(i % v)
            x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
            if x == (1, 0, 0):
                break
        if i == q ** 3 - 2 and x == (1, 0, 0):
            return np.array(sorted(set(found)))
    raise ValueError(f"{q} is not a prime")


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """v and the cover: the largest of these with v within two thirds of the length."""
    q = max(q for q in (2, 3, 5, 7, 11, 13, 17, 19, 23) if 3 * (q * q + q + 1) <= 2 * length)
    return q * q + q + 1, difference_cover(q)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.unbase = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.unbase, k, 2**64))])


class Slice:
    """Some texts of a block in one buffer, with names of any of their strings."""

    def __init__(self, texts: list[bytes], powers: list[Powers]):
        self.texts = texts
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        self.lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lens) - self.lens
        self.powers, self.sums = powers, {}

    def names(self, lo: np.ndarray, hi: np.ndarray, which: int = 0) -> np.ndarray:
        """Names of the strings [lo, hi) by one of the two hashes."""
        powers, n = self.powers[which], len(self.buf)
        powers.reach(n + 1)
        if which not in self.sums:
            self.sums[which] = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTES[which][self.buf] * powers.up[:n], out=self.sums[which][1:])
        sums = self.sums[which]
        return _mix((sums[hi] - sums[lo]) * powers.down[lo])


class Block:
    """What a block knows after the answers it has got; all of it is computed anew from its texts."""

    def __init__(self, texts: list[bytes], length: int, n_buckets: int):
        self.texts, self.length, self.n_buckets = texts, length, n_buckets
        self.v, self.cover = cover_for(length)
        self.name_len = length - self.v + 1
        self.shift = np.uint64(64 - int(log2(n_buckets)))
        self.powers = [Powers(b) for b in _BASES]

    def parts(self):
        for lo, hi in slices(self.texts, SLICE_BYTES):
            yield Slice(self.texts[lo:hi], self.powers)

    def samples(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the cover sample in the slice, with begin and end of their texts."""
        most = int(part.lens.max(initial=0))
        grid = (np.arange(0, most + self.v, self.v)[:, None] + self.cover).ravel()
        where, begin, end = [], [], []
        for s, n in zip(part.starts, part.lens):
            if n >= self.length:
                p = grid[:np.searchsorted(grid, n - self.name_len, "right")] + s
                where.append(p)
                begin.append(np.full(len(p), s))
                end.append(np.full(len(p), s + n))
        join = lambda xs: np.concatenate(xs) if xs else np.empty(0, np.int64)
        return join(where), join(begin), join(end)

    def shortened(self, names: np.ndarray) -> np.ndarray:
        """The bucket and 32 bits below it."""
        return names >> (self.shift - np.uint64(32))

    def bucket(self, names: np.ndarray) -> np.ndarray:
        return (names >> self.shift).astype(np.int64) if self.n_buckets > 1 else np.zeros(len(names), np.int64)

    # -- round 1 ------------------------------------------------------------
    def sample_names(self) -> np.ndarray:
        """Shortened names of all samples in order of place: bucket and 32 bits."""
        got = []
        for part in self.parts():
            p, _, _ = self.samples(part)
            got.append(part.names(p, p + self.name_len))
        names = np.concatenate(got) if got else np.empty(0, np.uint64)
        return self.shortened(names)

    # -- round 2 ------------------------------------------------------------
    def surroundings(self, repeated: np.ndarray):
        """Of the samples marked: index of slice, place, begin, end, name, the two names of the surroundings."""
        at, got = 0, []
        for k, part in enumerate(self.parts()):
            p, begin, end = self.samples(part)
            keep = repeated[at:at + len(p)]
            at += len(p)
            p, begin, end = p[keep], begin[keep], end[keep]
            lo, hi = np.maximum(begin, p - self.v + 1), np.minimum(end, p + self.length)
            shape = ((p - lo) * 65536 + (hi - p)).astype(np.uint64)
            got.append((np.full(len(p), k), p, begin, end, self.shortened(part.names(p, p + self.name_len)),
                        _mix(part.names(lo, hi) + _mix(shape)), _mix(part.names(lo, hi, 1) + _mix(shape)) >> np.uint64(32)))
        return [np.concatenate(x) for x in zip(*got)] if got else [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)] * 3

    def around(self, part: Slice, p, begin, end) -> np.ndarray:
        """True at the starts of the strings that contain one of these samples at its offset."""
        change = np.zeros(len(part.buf) + 1, np.int32)
        lo, hi = np.maximum(begin, p - self.v + 1), np.minimum(p, end - self.length) + 1
        ok = hi > lo
        np.add.at(change, lo[ok], 1)
        np.add.at(change, hi[ok], -1)
        return np.cumsum(change[:-1]) > 0

    # -- round 3 ------------------------------------------------------------
    def suffix_names(self, k, p, begin, end) -> list[np.ndarray]:
        """The two names of the suffixes around these samples."""
        got = []
        for i, part in enumerate(self.parts()):
            mine = k == i
            at = np.flatnonzero(self.around(part, p[mine], begin[mine], end[mine]))
            got.append((part.names(at, at + self.length), part.names(at, at + self.length, 1) >> np.uint64(32)))
        return [np.concatenate(x) for x in zip(*got)] if got else [np.empty(0, np.uint64)] * 2


def words(*keys: np.ndarray, wide: int) -> np.ndarray:
    """The keys as columns of 32-bit words: both words of the one at ``wide``, the low one of the others."""
    cols = [k.view(np.uint32).reshape(-1, 2) if i == wide else k.astype(np.uint32)[:, None] for i, k in enumerate(keys)]
    return np.concatenate(cols, axis=1)


def changes(keys: list[np.ndarray]) -> np.ndarray:
    """True where a sorted entry differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def sent(*keys: np.ndarray):
    """Order in which entries are sent (equal ones twice at most) and, for every entry, its place in it."""
    order = np.lexsort(keys[::-1])
    new = changes([k[order] for k in keys])
    second = np.zeros(len(new), bool)
    second[1:] = ~new[1:] & new[:-1]
    keep = new | second
    place = np.empty(len(new), np.int64)
    place[order] = (np.cumsum(keep) - 1 - second)[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(new) else 0
    return order[keep], place


def messages(block: int, stage: int, buckets: np.ndarray, payload: np.ndarray) -> pa.Table:
    """One row for each bucket that gets entries; ``buckets`` ascends."""
    ids, first = np.unique(buckets, return_index=True)
    ends = np.append(first, len(buckets))[1:]
    data = [payload[s:e].tobytes() for s, e in zip(first, ends)]
    return pa.table({"bucket": pa.array(ids, pa.int64()), "block": pa.array([block] * len(ids), pa.int64()),
                     "payload": pa.array(data, pa.binary())})


def answers(right: pa.Table, stage: int) -> np.ndarray:
    """The answers of a round in the order in which the entries were sent."""
    rows = [(b, x) for s, b, x in zip(right["stage"].to_pylist(), right["bucket"].to_pylist(), right["bits"].to_pylist()) if s == stage]
    return np.frombuffer(b"".join(x for _, x in sorted(rows)), np.uint8)


def block_round(stage: int, length: int, n_buckets: int):
    """The work of a block in rounds 1 to 3, and (4) its result."""

    def work(key, left: pa.Table, right: pa.Table | None = None) -> pa.Table:
        number = key[0].as_py()
        ids = left["doc_id"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))     # rows come in any order
        texts = [x or b"" for x in left["text"].cast(pa.binary()).to_pylist()]
        order.sort(key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        ids, texts = [ids[i] for i in order], [texts[i] for i in order]
        b = Block(texts, length, n_buckets)
        short = b.sample_names()
        out, place = sent(short)
        if stage == 1:
            low = short[out]
            return messages(number, 1, (low >> np.uint64(32)).astype(np.int64), low.astype(np.uint32))
        got = answers(right, 1)
        k, p, begin, end, name, *ctx = b.surroundings(got[place] > 0 if len(short) else np.zeros(0, bool))
        out, place = sent(name, *ctx)
        if stage == 2:
            return messages(number, 2, (name[out] >> np.uint64(32)).astype(np.int64), words(name[out], ctx[0][out], ctx[1][out], wide=1))
        flags = answers(right, 2)[place] if len(name) else np.zeros(0, np.uint8)
        first = np.zeros(len(name), bool)
        first[np.unique(place, return_index=True)[1]] = True           # one sample for each surroundings
        goes_on = first & (flags & 6 == 6)
        suffix = b.suffix_names(k[goes_on], p[goes_on], begin[goes_on], end[goes_on])
        out, place = sent(*suffix)
        if stage == 3:
            return messages(number, 3, b.bucket(suffix[0][out]), words(*(x[out] for x in suffix), wide=0))
        again = answers(right, 3)[place] > 0 if len(suffix[0]) else np.zeros(0, bool)
        settled = flags & 1 > 0
        rows, at = [], 0
        for i, part in enumerate(b.parts()):
            mine = k == i
            start = b.around(part, *(x[mine & settled] for x in (p, begin, end)))
            asked = np.flatnonzero(b.around(part, *(x[mine & goes_on] for x in (p, begin, end))))
            start[asked] |= again[at:at + len(asked)]
            at += len(asked)
            change = np.zeros(len(part.buf) + length + 1, np.int32)
            change[:len(start)] += start
            change[length:length + len(start)] -= start
            covered = np.cumsum(change)[:len(start)] > 0
            for s, n, text in zip(part.starts, part.lens, part.texts):
                c = covered[s:s + n]
                spans = int(c[:1].sum() + (c[1:] & ~c[:-1]).sum())
                kept = part.buf[s:s + n][~c].tobytes() if spans else text
                rows.append((int(n), int(c.sum()), spans, sha256(kept).hexdigest()))
        cols = list(zip(*rows))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(cols[0], pa.int64()),
                         "n_removed": pa.array(cols[1], pa.int64()), "n_spans": pa.array(cols[2], pa.int64()),
                         "kept_sha256": pa.array(cols[3], pa.string())})

    # Spark looks at the number of parameters
    return (lambda key, left: work(key, left)) if stage == 1 else (lambda key, left, right: work(key, left, right))


def owner_round(stage: int):
    """The work of a bucket's owner: sort its entries, answer each."""

    def work(key, rows: pa.Table) -> pa.Table:
        blocks, data = rows["block"].to_pylist(), rows["payload"].to_pylist()
        order = sorted(range(len(blocks)), key=blocks.__getitem__)
        parts = {1: 1, 2: 4, 3: 3}[stage]                               # words of an entry
        counts = [len(data[i]) // (4 * parts) for i in order]
        entries = np.frombuffer(b"".join(data[i] for i in order), np.uint32)
        del data
        keys = [entries[k::parts] for k in range(parts)]
        by = np.lexsort(keys[::-1])                                     # stable: the first block stays first
        keys = [k[by] for k in keys]
        new = changes(keys)
        run = np.cumsum(new) - 1
        repeated = np.bincount(run)[run] > 1
        bits = np.empty(len(by), np.uint8)
        if stage == 2:
            group = np.cumsum(changes(keys[:1])) - 1
            mixed = np.bincount(group[new])[group] > 1
            bits[by] = repeated + 2 * mixed + 4 * new
        else:
            bits[by] = repeated
        ends = np.cumsum(counts)
        return pa.table({"block": pa.array([blocks[i] for i in order], pa.int64()),
                         "stage": pa.array([stage] * len(order), pa.int64()),
                         "bucket": pa.array([key[0].as_py()] * len(order), pa.int64()),
                         "bits": pa.array([bits[e - n:e].tobytes() for n, e in zip(counts, ends)], pa.binary())})

    return lambda key, rows: work(key, rows)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of rounds that are written and done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def allow_buckets(spark: SparkSession, n: int) -> None:
    """Spark refuses bucketed tables beyond a number that is a setting of the session."""
    key = "spark.sql.sources.bucketing.maxBuckets"
    if int(spark.conf.get(key)) < n:
        spark.conf.set(key, n)


def remove_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int | None = None,
                   bucket_bytes: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    ``block_bytes`` (BLOCK_BYTES, for executors of 3 GB) is what a task holds as text and ``bucket_bytes``
    (BUCKET_BYTES) the input behind an owner's bucket: on 100 TB, 256 MB and 512 MB give 400,000 blocks and 262,144 owners.
    """
    spark = docs.sparkSession
    base = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, ceil(total / (block_bytes or BLOCK_BYTES)))
    n_buckets = 1 << max(0, ceil(log2(max(1, total / (bucket_bytes or BUCKET_BYTES)))))
    allow_buckets(spark, n_blocks)
    folder = shared_scratch(spark, "repeats")
    name = "repeats_" + folder.rsplit("-", 1)[1]
    (base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
         .repartition(n_blocks, "block").write.bucketBy(n_blocks, "block")
         .option("path", folder + "/blocks").option("compression", "zstd").saveAsTable(name))
    release(spark)
    blocks = spark.table(name)
    answered = None
    for stage in (1, 2, 3):
        work = block_round(stage, length, n_buckets)
        schema = "bucket long, block long, payload binary"
        groups = blocks.groupBy("block")
        asked = (groups.applyInArrow(work, schema) if stage == 1 else
                 groups.cogroup(answered.groupBy("block")).applyInArrow(work, schema))
        (asked.groupBy("bucket").applyInArrow(owner_round(stage), "block long, stage long, bucket long, bits binary")
              .write.parquet(f"{folder}/answers/{stage}"))
        del asked
        release(spark)
        schema = "block long, stage long, bucket long, bits binary"
        answered = spark.read.schema(schema).parquet(*(f"{folder}/answers/{k}" for k in range(1, stage + 1)))
    result = blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        block_round(4, length, n_buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    result.write.parquet(folder + "/result")
    spark.sql(f"drop table {name}")
    return spark.read.parquet(folder + "/result")
