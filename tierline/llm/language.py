"""Language identification by hyperdimensional profiles.

Every letter stands for a random vector of ``DIM`` signs, worked out from its code point
by a mixing function, so nothing is stored or shipped. An n-gram of three letters (a
blank marks both ends of a word) binds them: the product of the first letter's vector
permuted twice, the second's permuted once and the third's. A text bundles its n-grams:
the sum of their vectors, as whole numbers. A language's prototype is the bundle of all
its training texts; a document gets the language whose prototype has the largest cosine
with its own bundle.

Bundles are sums, so training is one pass in which each task adds up its texts by
language and sends ``DIM`` numbers a language; Spark adds these up. Scoring is a second
pass without a shuffle. Prototypes are broadcast ``LANGUAGES`` at a time (8 bytes each
of ``DIM`` numbers, 2 MB at most); with more languages the best so far is written beside
the text and the next block reads it. n-gram vectors are remembered up to ``GRAMS``
(float32, 32 MB), texts are cut between words into parts of ``PART`` code points,
which changes no sum.

Learning uses rows with a language and crc32(doc_id) mod 4 other than 2. Letters are
Unicode's (class L), in lower case.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0, as
is every text where no language was learned; such texts teach nothing, so a language
that has no others is not learned; an empty string is a language like any other; of equal cosines the smaller name counts;
a negative cosine is score 0; repeated rows are scored alike and learned each; bytes
that are no UTF-8 are no letters; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import crc_remainder, fold, scan, ship

DIM = 1024                      # a multiple of 64
LANGUAGES = 256                 # prototypes held by a task at one time
GRAMS = 8192                    # n-gram vectors remembered by a task
PART = 1 << 20
UNKNOWN = "und"
BLANK = 32
_LETTERS, _OTHER = regex.compile(r"\p{L}+"), regex.compile(r"\P{L}")
_MASK = (1 << 21) - 1


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """(n, DIM / 64) words of random bits for code points: splitmix64 of the point and the word's number."""
    z = points.astype(np.uint64)[:, None] * np.uint64(DIM // 64) + np.arange(DIM // 64, dtype=np.uint64)
    z = (z + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bound(grams: np.ndarray) -> np.ndarray:
    """(n, DIM) signs of n-grams. Signs multiply as bits are xor-ed; the permutation moves all places on by 64."""
    first, second, third = (letter_vectors(grams >> s & _MASK) for s in (42, 21, 0))
    bits = np.roll(first, 2, axis=1) ^ np.roll(second, 1, axis=1) ^ third
    return 1 - 2 * np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)


def parts(text: str) -> Iterator[str]:
    """The text in pieces that end between words."""
    at = 0
    while at < len(text):
        cut = _OTHER.search(text, at + PART) if at + PART < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def grams(text: str) -> np.ndarray:
    """The n-grams of all words as numbers, in order."""
    words = _LETTERS.findall(text.lower())
    if not words:
        return np.empty(0, np.int64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    found = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    return found[points[1:-1] != BLANK]


class Bundler:
    """Adds up n-gram vectors; remembers those met last."""

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((GRAMS, DIM), np.float32)

    def _at(self, ids: list[int]) -> list[int]:
        new = [g for g in ids if g not in self.rows]
        if len(self.rows) + len(new) > GRAMS:
            self.rows.clear()
            new = ids
        if new:
            n = len(self.rows)
            self.vectors[n:n + len(new)] = bound(np.array(new, np.int64))
            self.rows.update(zip(new, range(n, n + len(new))))
        return [self.rows[g] for g in ids]

    def bundle(self, found: np.ndarray) -> np.ndarray:
        """Whole numbers, exact: float32 is used only where it holds them."""
        ids, counts = np.unique(found, return_counts=True)
        total = np.zeros(DIM)
        for lo in range(0, len(ids), GRAMS // 2):
            n = counts[lo:lo + GRAMS // 2]
            vectors = self.vectors[self._at(ids[lo:lo + GRAMS // 2].tolist())]
            total += n.astype(np.float32) @ vectors if n.sum() < 1 << 24 else n.astype(np.float64) @ vectors
        return total

    def of_text(self, text: bytes) -> np.ndarray:
        return sum((self.bundle(grams(p)) for p in parts(text.decode(errors="replace"))), np.zeros(DIM))


def prototypes(docs: DataFrame, lang_col: str = "lang") -> DataFrame:
    """lang, at, value: the bundle of every language's training texts, in a written table."""
    learn = docs.where(docs[lang_col].isNotNull() & (crc_remainder(docs["doc_id"].cast("long"), 4) != 2))
    learn = learn.select(learn[lang_col].cast("string").alias("lang"), learn["text"].cast("string").alias("text"))

    def make():
        bundler, held = Bundler(), {}

        def add(columns, texts):
            for lang in set(columns[0]):
                mine = [t for name, t in zip(columns[0], texts) if name == lang]
                held[lang] = held.get(lang, 0) + bundler.of_text(b" ".join(mine))
            return len(held) >= LANGUAGES

        def flush():
            some = {lang: v for lang, v in held.items() if v.any()}
            held.clear()
            return {"lang": [lang for lang in some for _ in range(DIM)], "at": list(range(DIM)) * len(some),
                    "value": pa.array(np.concatenate([np.empty(0), *some.values()]).astype(np.int64))}
        return add, flush

    found = fold(learn, make, "lang string, at int, value long")
    return cut_lineage(found.groupBy("lang", "at").agg(F.sum("value").alias("value")), "language-prototypes")


def blocks(found: DataFrame, size: int = LANGUAGES) -> Iterator[tuple[list[str], np.ndarray]]:
    """The prototypes in the order of their names, ``size`` languages at a time, with length 1."""
    last = None
    while True:
        rest = found if last is None else found.where(F.col("lang") > F.lit(last))
        names = [r["lang"] for r in rest.select("lang").distinct().orderBy("lang").limit(size).collect()]
        if not names:
            return
        last, at = names[-1], {name: k for k, name in enumerate(names)}
        vectors = np.zeros((len(names), DIM))
        for r in rest.where(F.col("lang") <= F.lit(last)).collect():          # DIM rows a language
            vectors[at[r["lang"]], r["at"]] = r["value"]
        yield names, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def predict(docs: DataFrame, found: DataFrame, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    doc_id = docs["doc_id"].cast("long")
    rows = docs.select(doc_id.alias("doc_id"), (crc_remainder(doc_id, 4) == 2).alias("held_out"),
                       F.lit(UNKNOWN).alias("lang_pred"), F.lit(-2.0).alias("score"), docs["text"].cast("string").alias("text"))
    left = blocks(found, languages)
    block = next(left, None)
    while block:
        after = next(left, None)
        schema = "doc_id long, held_out boolean, lang_pred string, score double" + (", text binary" if after else "")
        rows = scan(rows, _comparing(ship(docs, block)), schema)
        if after:
            rows = cut_lineage(rows, "language-best")
        block = after
    return rows.select("doc_id", "held_out", "lang_pred", F.greatest("score", F.lit(0.0)).alias("score"))


def _comparing(shipped):
    def make():
        bundler, (names, vectors) = Bundler(), shipped.value

        def compare(text: bytes, lang: str, score: float) -> tuple[str, float]:
            mine = bundler.of_text(text)
            length = np.sqrt(mine @ mine)
            if not length:
                return UNKNOWN, -2.0
            cosines = np.minimum(vectors @ mine / length, 1.0)
            best = int(cosines.argmax())
            return (names[best], float(cosines[best])) if cosines[best] > score else (lang, score)

        def work(columns, texts):
            got = [compare(*x) for x in zip(texts, columns[2], columns[3])]
            return {"doc_id": columns[0], "held_out": columns[1], "lang_pred": [x[0] for x in got], "score": [x[1] for x in got], "text": texts}
        return work
    return make


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, prototypes(docs))
