"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Training takes a bounded sample of the labelled rows (``SAMPLE_ROWS``, the
smallest id hashes), dealt to ``SHARDS`` tasks; each runs FTRL over its rows and
the weights are averaged. Scoring is one pass over all texts without a shuffle:
the dot product of a text's n-gram shares with the weights.

Defined cases: null and empty texts have no n-grams and get the bias alone;
without labels every score is 0.5; a document labelled twice takes the lower
label; labels without a document are unused; rows are scored one by one, so
repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, id_and_text, scan, ship, text_bytes

BITS = 18                       # 2**18 weights: 2 MB, the bound of what is broadcast
SAMPLE_ROWS = 12_000            # labelled rows used for training, at most
SHARDS = 4                      # trained apart, then averaged
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.001, 0.01
SCALE = 8.0                     # n-gram shares of a text add up to this much
THRESHOLD = 0.7
CACHE_WORDS, CACHE_LETTERS = 200_000, 64       # word hashes remembered by a task, of words of so many bytes at most

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
_SHAPES = ((re.compile(rb"[0-9]+\Z"), b"digits"), (re.compile(rb"[^0-9A-Za-z\x80-\xff]"), b""),
           (re.compile(rb"[A-Z][A-Z\x80-\xff]+\Z"), b"upper"), (re.compile(rb"[A-Z]"), b"title"))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """word -> its hash (high half) and the hash of its shape (low half)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        shape = next((name or word for pattern, name in _SHAPES if pattern.match(word)), b"lower")
        value = crc32(word) << 32 | crc32(b"shape " + shape)
        if len(word) <= CACHE_LETTERS:
            self[word] = value
        return value


def ngram_slots(text: bytes, hashes: dict) -> np.ndarray:
    """Weight slots of all n-grams: words and pairs of words; pairs and triples
    of word shapes, where a word that repeats the one before has its own shape."""
    words = _TOKEN.findall(text)
    if not words:
        return np.empty(0, np.int64)
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    shape[1:][word[1:] == word[:-1]] = 7
    pair = shape[:-1] * np.uint64(31) + shape[1:]
    grams = [word, word[:-1] * np.uint64(0x85EBCA6B) + word[1:] + np.uint64(1),
             pair + np.uint64(2 << 40), pair[:-1] * np.uint64(31) + shape[2:] + np.uint64(3 << 40)]
    return (np.concatenate(grams) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(texts: list[bytes], labels: list[int]) -> np.ndarray:
    """Weights after EPOCHS passes of per-coordinate FTRL; the last one is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    hashes = _Hashes()

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for text, label in zip(texts, labels):
            slots = ngram_slots(text, hashes)
            at, counts = np.unique(slots, return_counts=True)
            at = np.append(at, size - 1)
            x = np.append(counts * (SCALE / max(1, len(slots))), 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(size))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Averaged weights, learnt from labelled rows whose crc32(doc_id) mod 4 is not 2."""
    chosen = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
              .where("doc_id is not null and y is not null")
              .where(crc_remainder(F.col("doc_id"), 4) != 2)
              .groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = (id_and_text(docs).join(F.broadcast(chosen), "doc_id")       # 16 bytes x sample_rows at most
            .withColumn("shard", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(SHARDS))))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.lexsort((pdf["doc_id"], [crc32(str(i).encode()) for i in pdf["doc_id"]]))]
        w = ftrl([(t or "").encode() for t in pdf["text"]], pdf["y"].tolist())
        return pd.DataFrame({"n": [len(pdf)], "w": [w.tobytes()]})

    parts = rows.groupBy("shard").applyInPandas(fit, "n long, w binary").collect()    # SHARDS rows
    total = sum(r["n"] for r in parts)
    if not total:
        return np.zeros((1 << BITS) + 1)
    return sum(np.frombuffer(r["w"]) * (r["n"] / total) for r in parts)


def score_text(text: bytes, w: np.ndarray, hashes: dict) -> float:
    slots = ngram_slots(text, hashes)
    dot = w[-1] + (w[slots].sum() * (SCALE / len(slots)) if len(slots) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(dot, -30, 30))))


def score(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shipped = ship(docs, w)

    def make():
        hashes, weights = _Hashes(), shipped.value

        def work(columns, texts):
            got = [score_text(t, weights, hashes) for t in texts]
            return {"doc_id": columns[0], "held_out": columns[1], "score": got,
                    "predicted": [int(s >= THRESHOLD) for s in got]}
        return work

    two = id_and_text(docs)
    return scan(two.select("doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text"),
                make, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, w: np.ndarray) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    shipped = ship(docs, w)

    def keep(batches):
        hashes, weights = _Hashes(), shipped.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            mask = [score_text(t, weights, hashes) >= THRESHOLD for t in text_bytes(texts)]
            yield batch.filter(np.array(mask, bool)) if batch.num_rows else batch

    return docs.mapInArrow(keep, docs.schema)
