"""Benchmark decontamination: one Aho-Corasick automaton over normalised items.

Texts are normalised to lower-cased words with one blank between and around
them; every window of ten item words is a pattern, so a hit is a run of whole
words. Each document is scanned once by an automaton and the hit words are mapped back to code points of the
original text in one pass.

A usual benchmark is one group, one automaton, one pass without a shuffle. A larger one is written to the shared folder in
groups of about ``GROUP_BYTES``, dealt by a hash of its items (long items in overlapping parts of ``PART_WORDS`` words); then the groups are taken one
after the other: the driver holds one group's text, a task one group's automaton, and each pass writes the hits of the documents
that have some. Runs and items are put together by document at the end.

Defined cases: null or empty texts and items have no words and no windows; an
item without id is unused; an id given twice is one item with the windows of
both rows; repeated documents give equal rows; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_scratch
from .common import id_and_text, scan, ship, text_bytes

WINDOW_WORDS = 10
GROUP_BYTES = 512 << 10         # benchmark text in one automaton: tens of MB of nodes
PART_WORDS = 5000

_FOLD = bytes((i + 32 if 65 <= i <= 90 else i) if chr(i).isascii() and chr(i).isalnum() or i > 127 else 32
              for i in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(items: list[tuple[str, bytes]], width: int = WINDOW_WORDS) -> dict[str, tuple[int, set]]:
    """pattern -> (its number of words, ids of the items it comes from)."""
    out: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            part = words[i:i + width]
            out.setdefault((b" " + b" ".join(part) + b" ").decode("latin-1"), (len(part), set()))[1].add(item_id)
    return out


def automaton(patterns: dict[str, tuple[int, set]]):
    a = ahocorasick.Automaton()
    for text, value in patterns.items():
        a.add_word(text, value)
    a.make_automaton()
    return a


def hits(text: bytes, a) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged runs of hit words (start, end exclusive), items hit."""
    words = words_of(text)
    plain = b" " + b" ".join(words) + b" "
    found, items = [], set()
    gaps = None
    for end, (n, ids) in a.iter(plain.decode("latin-1")) if len(a) and words else ():
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
        last = int(np.searchsorted(gaps, end))
        found.append((last - n, last))
        items |= ids
    return len(words), merge(found), items


def merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def to_original(text: bytes, runs: list[tuple[int, int]]) -> list[str]:
    """Runs of words (in order) as start:end in code points of the text as it was; every byte is decoded once."""
    out, at, point = [], 0, 0
    want = iter([k for s, e in runs for k in (s, e - 1)])
    k, first = next(want, None), True
    for n, m in enumerate(_WORD.finditer(text)):
        while n == k:
            to = m.start() if first else m.end()
            point += len(text[at:to].decode("utf-8", "surrogateescape"))
            at = to
            out.append(point)
            k, first = next(want, None), not first
        if k is None:
            break
    return [f"{s}:{e}" for s, e in zip(out[::2], out[1::2])]


def groups(benchmark: DataFrame, limit: int = GROUP_BYTES, *, width: int = WINDOW_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """The items, one group of about ``limit`` bytes at a time; long items come in parts that share all windows."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("i"),
                             F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("t")).where("i is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_groups = ceil(total / limit)
    if n_groups <= 1:
        yield [(r["i"], r["t"].encode("utf-8", "surrogateescape")) for r in items.where("t <> ''").collect()]     # limit bytes at most
        return
    def cut(batches):
        for batch in batches:
            ids, texts = [], []
            for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = words_of(t)
                for at in range(0, max(1, len(words) - width + 1) if words else 0, PART_WORDS):
                    ids.append(i)
                    texts.append(b" ".join(words[at:at + PART_WORDS + width - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())], names=["i", "t"])

    parts = cut_lineage(items.mapInArrow(cut, "i string, t binary").withColumn(
        "part_of", F.pmod(F.xxhash64("i", "t"), F.lit(n_groups))), "benchmark-groups")
    for k in range(n_groups):
        yield [(r["i"], bytes(r["t"])) for r in parts.where(F.col("part_of") == k).collect()]


_HITS = "n_words long, runs array<struct<s:long,e:long>>, spans array<string>, items array<string>"


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, runs (word runs hit), spans (the same in the original text), items."""
    left = groups(benchmark, width=width)
    items, following = next(left), next(left, None)
    if following is None:
        return scan(id_and_text(docs), _pass(ship(docs, items), width), f"doc_id long, {_HITS}")
    rows = cut_lineage(id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "documents")
    folder, k = shared_scratch(rows.sparkSession, "hits"), 0
    while items is not None:
        hit = scan(rows.select("row", "text"), _pass(ship(docs, items), width, "row"), f"row long, {_HITS}").where("size(runs) > 0")
        hit.select("row", "runs", "items").write.parquet(f"{folder}/{k}")
        items, following, k = following, next(left, None), k + 1
    found = rows.sparkSession.read.parquet(*(f"{folder}/{i}" for i in range(k))).groupBy("row").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = rows.join(cut_lineage(found, "hits"), "row", "left")
    none = F.expr("cast(array() as array<string>)")
    return scan(joined.select("doc_id", "runs", F.coalesce("items", none).alias("items"), "text"), _together, f"doc_id long, {_HITS}")


def _pass(items, width: int, key: str = "doc_id"):
    def make():
        a = automaton(windows(items.value, width))

        def work(columns, texts):
            got = [hits(t, a) for t in texts]
            return {key: columns[0], "n_words": [n for n, _, _ in got], "runs": [[{"s": s, "e": e} for s, e in runs] for _, runs, _ in got],
                    "spans": [to_original(t, runs) if key == "doc_id" else [] for t, (_, runs, _) in zip(texts, got)],
                    "items": [sorted(found) for _, _, found in got]}
        return work
    return make


def _together():
    def work(columns, texts):
        runs = [merge([(r["s"], r["e"]) for r in x or ()]) for x in columns[1]]
        return {"doc_id": columns[0], "n_words": [len(words_of(t)) for t in texts], "runs": [[{"s": s, "e": e} for s, e in x] for x in runs],
                "spans": [to_original(t, x) for t, x in zip(texts, runs)], "items": columns[2]}
    return work


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest per document: counts, items, whether it is contaminated."""
    m = mark(docs, benchmark)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda t, r: t + r["e"] - r["s"])
    return m.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
                    (F.size("runs") > 0).alias("contaminated"), F.array_join("spans", ",").alias("hit_spans"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark. With several groups, what is left is written between them."""
    out, left = docs, groups(benchmark, width=width)
    items = next(left)
    while items is not None:
        shipped = ship(docs, items)

        def keep(batches, shipped=shipped):
            a = automaton(windows(shipped.value, width))
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                mask = [not hits(t, a)[1] for t in text_bytes(texts)]
                yield batch.filter(np.array(mask, bool)) if batch.num_rows else batch
        out, items = out.mapInArrow(keep, out.schema), next(left, None)
        if items is not None:
            out = cut_lineage(out, "clean")
    return out
