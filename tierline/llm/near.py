"""Near-duplicate documents by MinHash, banding, verification and star components.

1. Each text's set of word shingles gives ``PERMUTATIONS`` minima of universal
   hashes, ``BANDS`` band keys, a 128-bit sketch (one bit of each minimum) and a
   128-bit fingerprint of the set. Texts with equal sets are one class at once,
   so thousands of copies are one node from here on.
2. Classes that share a band key are compared with one class of that key, the one that shares
   keys with the most others (a star, never all pairs). Pairs whose sketches are far apart are left out (a
   pair at the threshold is that far apart with odds under 1e-8), the others
   are verified on their full shingle sets.
3. Components by alternating large-star and small-star.
4. Where the classes of a band key are still in different components, the pairs
   between those components are verified too; pairs inside one component cannot change
   the result. One join makes them, its condition held to near sketches and to an upper
   bound of what the sets can have in common (:func:`_most`).
   Then components once more. So no link that matters is lost to the star.

With 32 bands of 4 rows a pair at similarity 0.8 shares a key but for odds of 5e-8.

Defined cases: null, empty and blank texts have an empty set and link with
nothing, not even each other; a text of fewer words than a shingle is one
shingle; rows without doc_id link with nothing (component_id null, kept);
rows that share a doc_id but not a text are judged row by row, and a link of one
such text holds for the id; other columns are ignored.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from ..session import cut_lineage
from .common import id_and_text, scan

WIDTH = 5                       # words in a shingle
THRESHOLD = 80                  # per cent
PERMUTATIONS, BANDS = 128, 32
MAX_SKETCH_BITS = 36            # at similarity 0.8 the sketches differ in 12.8 bits, deviation 3.4
CACHE_WORDS, CACHE_LETTERS = 200_000, 64       # word hashes remembered by a task, of words of so many bytes at most

_FOLD = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_RNG = np.random.default_rng(20240229)
_A = (_RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_W = (_RNG.integers(1, 2**63, 16, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_BLOCK = 1024


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LETTERS:
            self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.translate(_FOLD).split()
    if not words:
        return np.empty(0, np.uint64)
    h = _mix(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
    if len(words) < width:
        whole = np.array([len(words)], np.uint64)
        for i in range(len(h)):
            whole = _mix(whole * _W[15] + h[i:i + 1])
        return whole
    n = len(words) - width + 1
    out = h[:n] * _W[0]
    for k in range(1, width):
        out += h[k:k + n] * _W[k]
    return np.unique(_mix(out))


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash a*x+b over the set."""
    out = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), _BLOCK):
        values = np.multiply(_A[:, None], s[None, i:i + _BLOCK])
        np.add(values, _B[:, None], out=values)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def signature(s: np.ndarray) -> tuple[int, int, list[int], int, int]:
    """Fingerprint (two longs), band keys, sketch (two longs)."""
    with np.errstate(over="ignore"):
        f1, f2 = np.add.reduce(_mix(s + np.uint64(1))), np.bitwise_xor.reduce(_mix(s + np.uint64(2)))
        low = minima(s)
        rows = low.reshape(BANDS, -1) >> np.uint64(16)
        key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
        for column in rows.T:
            key = _mix(key * _W[14] + column)
    bits = np.packbits((low >> np.uint64(40) & np.uint64(1)).astype(np.uint8)).view(np.int64)
    return int(f1.view(np.int64)), int(f2.view(np.int64)), key.view(np.int64), int(bits[0]), int(bits[1])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    def make():
        hashes = WordHashes()

        def work(columns, texts):
            out = {k: [] for k in ("doc_id", "n", "f1", "f2", "bands", "k0", "k1")}
            for i, text in zip(columns[0], texts):
                s = shingles(text, width, hashes)
                got = signature(s) if len(s) else (0, 0, None, 0, 0)
                for k, x in zip(out, (i, len(s), *got)):
                    out[k].append(x)
            return out
        return work

    return scan(id_and_text(docs), make, "doc_id long, n long, f1 long, f2 long, bands array<long>, k0 long, k1 long")


def compare(a: np.ndarray, b: np.ndarray, threshold: int) -> tuple[bool, int, int, list[int]]:
    """Whether two sets are linked, what they have in common, the size of the second, and where
    in 256 places (by hash) lie those of the second that the first lacks."""
    lacks = np.setdiff1d(b, a, assume_unique=True)
    both = len(b) - len(lacks)
    places = np.zeros(256, np.uint8)
    places[(lacks & np.uint64(255)).astype(np.int64)] = 1
    return (100 * both >= threshold * (len(a) + len(b) - both), both, len(b), np.packbits(places).view(np.int64).tolist())


_COMPARED = "u long, v long, linked boolean, both long, n_v long, p0 long, p1 long, p2 long, p3 long"


def compared(pairs: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """Every pair (u, v) with the comparison of its texts' full sets."""

    def make():
        hashes = WordHashes()

        def work(columns, texts):
            out = {k: [] for k in ("u", "v", "linked", "both", "n_v", "p0", "p1", "p2", "p3")}
            for right, run in groupby(zip(*columns, texts), key=lambda x: x[-1]):      # the second set once a run
                b = shingles(right, width, hashes)
                for u, v, left, _ in run:
                    a = shingles(left, width, hashes)
                    linked, both, n_v, places = compare(a, b, threshold)
                    for k, x in zip(out, (u, v, linked, both, n_v, *places)):
                        out[k].append(x)
            return out
        return work

    sides = (pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("left")), "u")
                  .join(texts.select(F.col("id").alias("v"), F.col("text").alias("right")), "v"))
    return scan(sides.select("u", "v", F.col("left").cast("binary"), "right"), make, _COMPARED)


def core_sizes(texts: DataFrame, width: int) -> DataFrame:
    """id, n, core: the size of a text's set, and how many of it some other of these texts has too."""

    def make():
        hashes = WordHashes()

        def work(columns, texts):
            sets = [shingles(t, width, hashes).view(np.int64) for t in texts]
            lens = [len(s) for s in sets]
            return {"id": np.repeat(np.array(columns[0], np.int64), lens).tolist(), "n": np.repeat(lens, lens).tolist(),
                    "shingle": pa.array(np.concatenate([np.empty(0, np.int64), *sets]))}
        return work

    rows = scan(texts.select("id", "text"), make, "id long, n long, shingle long")
    found = rows.groupBy("shingle").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    alone = found.where("lo = hi").groupBy("lo").agg(F.count("*").alias("alone"))
    # an id with several texts: the smallest size, and no less than the core of any of them
    size = rows.groupBy("id").agg(F.min("n").alias("n"), F.count("*").alias("all"))
    return (size.join(alone, size["id"] == alone["lo"], "left")
            .select(F.col("id").alias("rep"), "n", (F.col("all") - F.coalesce("alone", F.lit(0))).alias("core")))


def components(edges: DataFrame) -> DataFrame:
    """node -> component (its smallest node) for every node of an edge."""
    def state(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u <> v").distinct(), "edges")
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(least.select("u", F.col("m").alias("v"))))
        edges = cut_lineage(small.distinct(), "edges")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .union(edges.select("v", "v")).distinct())


def _far(a: str, b: str) -> Column:
    return (F.bit_count(F.col(f"{a}k0").bitwiseXOR(F.col(f"{b}k0")))
            + F.bit_count(F.col(f"{a}k1").bitwiseXOR(F.col(f"{b}k1"))))


def _most() -> Column:
    """An upper bound of what the sets of x and y have in common.

    Shingles that no other class has are not common. Within the centre's set, of
    the n_c shingles x lacks some and y lacks some; both lack at most what is left of x's when the
    places that only x lacks are taken off, and the same for y. Outside of it, each has
    its core less what it shares with the centre.
    """
    core = F.least("xcore", "ycore")
    only = lambda a, b: sum((F.bit_count(F.col(f"{a}p{i}").bitwiseAND(F.bitwise_not(f"{b}p{i}"))) for i in range(4)), F.lit(0))
    both_lack = F.least(F.col("xlacks") - only("x", "y"), F.col("ylacks") - only("y", "x"))
    inside = F.col("xn_c") - F.col("xlacks") - F.col("ylacks") + both_lack
    outside = F.least(F.col("xcore") - F.col("xboth"), F.col("ycore") - F.col("yboth"))
    return F.least(core, F.coalesce(inside + outside, core))


def find_near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    base = id_and_text(docs)
    sig = cut_lineage(signatures(docs, width), "signatures")
    named = sig.where("n > 0 and doc_id is not null")
    # classes of equal sets; the map side sums up copies
    classes = cut_lineage(named.groupBy("f1", "f2", "n")
                          .agg(F.min(F.struct("doc_id", "k0", "k1", "bands")).alias("r"))
                          .select("f1", "f2", "n", F.col("r.doc_id").alias("rep"), "r.k0", "r.k1", "r.bands"), "classes")
    members = classes.select(F.explode("bands").alias("key"), "rep", "k0", "k1")
    # a key may hold a third of all classes: what is joined to it is written first, so that Spark can split it
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut_lineage(split_join(members, sizes, ["key"], "inner"), "buckets")
    # the centre of a key: its class that shares keys with the most classes, in a group of
    # near copies the one that the others were made from
    fame = shared.groupBy("rep").agg(F.sum("size").alias("fame"))
    famous = shared.join(fame, "rep")
    centres = (famous.groupBy("key").agg(F.max(F.struct("fame", "rep", "k0", "k1")).alias("c"))
               .select("key", F.col("c.rep").alias("centre"), F.col("c.k0").alias("ck0"), F.col("c.k1").alias("ck1")))
    shared = cut_lineage(split_join(shared, centres, ["key"], "inner"), "stars")
    pairs = cut_lineage(shared.where((F.col("rep") != F.col("centre")) & (_far("", "c") <= MAX_SKETCH_BITS))
                        .select(F.col("rep").alias("u"), F.col("centre").alias("v")).distinct(), "pairs")
    # whole texts of the classes that share a key with another class
    involved = shared.select(F.col("rep").alias("id")).distinct()
    texts = cut_lineage(base.withColumnRenamed("doc_id", "id").join(involved, "id", "left_semi"), "texts")
    to_centre = cut_lineage(compared(pairs, texts, width, threshold), "links")
    edges = to_centre.where("linked").select("u", "v")
    label = components(edges)
    # keys whose classes are in several components: pairs between those
    labelled = shared.join(label, shared["rep"] == label["node"], "left").select(
        "key", "rep", "k0", "k1", "centre", F.coalesce("component", "rep").alias("part"))
    split = (labelled.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("size"))
             .where("lo <> hi and size > 2").select("key"))
    mixed = cut_lineage(split_join(labelled, split, ["key"], "left_semi").where("rep <> centre"), "mixed")
    named = mixed.select(F.col("rep").alias("id")).union(mixed.select("centre")).distinct()
    cores = cut_lineage(core_sizes(texts.join(named, "id"), width), "cores")
    # of rows that share a doc_id, the greatest counts: they only have to bound from above
    lie = to_centre.groupBy(F.col("u").alias("rep"), F.col("v").alias("centre")).agg(
        F.max("both").alias("both"), F.max("n_v").alias("n_c"), F.count("*").alias("times"), *(F.max(p).alias(p) for p in ("p0", "p1", "p2", "p3")))
    mixed = mixed.join(cores, "rep").join(lie, ["rep", "centre"], "left").withColumn("lacks", F.when(F.col("times") == 1, F.col("n_c") - F.col("both")))
    names = ("key", "rep", "k0", "k1", "part", "n", "core", "both", "n_c", "lacks", "p0", "p1", "p2", "p3")
    x = mixed.select(*(F.col(c).alias("x" + c) for c in names))
    y = mixed.select(*(F.col(c).alias("y" + c) for c in names))
    across = x.join(y, (F.col("xkey") == F.col("ykey")) & (F.col("xpart") < F.col("ypart")) & (_far("x", "y") <= MAX_SKETCH_BITS)
                    & (100 * _most() >= threshold * (F.col("xn") + F.col("yn") - _most())))
    found = cut_lineage(across.select(F.col("xrep").alias("u"), F.col("yrep").alias("v")).distinct(), "across")
    more = compared(found, texts, width, threshold).where("linked").select("u", "v")
    label = components(edges.union(more))
    nodes = (classes.select("f1", "f2", "n", "rep").join(label, F.col("rep") == F.col("node"), "left")
             .select("f1", "f2", "n", F.coalesce("component", "rep").alias("component_id")))
    out = sig.join(nodes, ["f1", "f2", "n"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                      (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def representatives(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns: one document of each component stays."""
    dropped = (find_near_duplicates(docs, width, threshold).where("not kept")
               .select(F.col("doc_id").alias("dropped_id")).distinct())
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["dropped_id"], "left_anti")
