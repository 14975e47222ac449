"""Hidden Markov language model over words, and the count model beside it.

Corpus counts: every task counts the tokens of its training texts, Spark sums the
counts. The ``OWN`` most frequent words are symbols of their own; every other word
belongs to one of ``CLASSES`` classes by its last two bytes, and a state emits it with
the class's probability times the word's share within the class. So the model is
a distribution over all words, however many there are.

Training: Baum-Welch. Each task runs scaled forward-backward over its whole texts, many
side by side, and emits expected counts by symbol; Spark adds them
up over the partitions and the driver - which only ever holds symbols x states numbers -
re-estimates. Every one of the ``PASSES`` rounds reads the whole training corpus; the
first starts from the corpus-wide symbol counts, set apart between the states by a fixed
random factor. Texts are turned into symbols once, in a table that all rounds and the scoring read.
Memory does not grow with a text's length: forward vectors are kept at the borders of windows of steps only, and
a window's own are worked out again on the way back. Texts over ``LONG_TEXT`` tokens are held back (two
bytes a token) until ``HELD_BYTES`` of them, or the task's last, can go side by side.

Scoring: the scaled forward recursion over each whole text gives its exact
likelihood, in log10. Counts of about ``KNOWN`` most frequent words (of those with the last count
among them, the ones with the smallest hashes) go to the tasks as a table of bounded size; a text's rarer words are joined with the counts by word, which
Spark can split, and summed by text.

Defined cases: null and empty texts are the end token alone; rows without doc_id have the
id text ''; repeated rows count and are scored each; without training texts every
count is 0; other columns are ignored. Words longer than ``LONG`` bytes are never put
into the table, so its size is bounded.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import crc_remainder, fold, id_and_text, scan, ship, slices

STATES, OWN, KNOWN, CLASSES = 8, 16_384, 131_072, 256
PASSES = 8
CHUNK_BYTES = 1 << 20           # symbols (two bytes each) that forward-backward takes at one time
LONG_TEXT, HELD_BYTES = 1024, 8 << 20
WINDOW_CELLS = 1 << 19          # symbols whose forward vectors are held at one time: 64 bytes each, and as much for their emissions
LONG, FLUSH_WORDS, SEED = 64, 250_000, 11

_FOLD = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def class_of(word: bytes) -> int:
    return crc32(word[-2:]) % CLASSES


def count_tokens(train: DataFrame) -> DataFrame:
    """word, c over all training texts; the end token is not a row (it occurs once a text)."""

    def make():
        counts: Counter = Counter()

        def add(columns, texts):
            for t in texts:
                counts.update(words_of(t))
            return len(counts) > FLUSH_WORDS

        def flush():
            out = {"word": pa.array(list(counts), pa.binary()), "n": list(counts.values())}
            counts.clear()
            return out
        return add, flush

    part = fold(train, make, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("c"))


class Symbols:
    """What every task knows: frequent words, their counts and symbols, and the classes."""

    def __init__(self, words: list[tuple[bytes, int]], classes: np.ndarray, total: int, distinct: int):
        """words: by descending count; classes: (CLASSES, 2) tokens and words that have no symbol of their own."""
        self.index = {w: i for i, (w, _) in enumerate(words)}
        self.counts = np.array([c for _, c in words] + [0], np.float64)      # the last one: unknown here
        self.own = min(OWN, len(words))
        self.end = self.own + CLASSES
        self.size = self.end + 1
        self.symbol = np.array([i if i < self.own else self.own + class_of(w) for i, (w, _) in enumerate(words)] + [-1], np.int64)
        # training tokens by symbol; the end token has what is left
        self.weight = np.append(np.concatenate([self.counts[:self.own], classes[:, 0]]), 0.0)
        self.weight[-1] = total - self.weight.sum()
        self.class_sum = classes[:, 0] + 0.5 * (classes[:, 1] + 1)
        self.total, self.distinct = total, distinct
        self.base_sum = total + 0.5 * (distinct + 1)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Index (unknown: the last), symbol, and the places of the words that are not in the table."""
        last = len(self.counts) - 1
        index = np.fromiter(map(self.index.get, words, repeat(last)), np.int64, len(words))
        symbol = self.symbol[index]
        rare = np.flatnonzero(index == last).tolist()
        if rare:
            symbol[rare] = [self.own + class_of(words[i]) for i in rare]
        return index, symbol, rare

    def observations(self, text: bytes) -> np.ndarray:
        return np.append(self.look_up(words_of(text))[1], self.end)


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit      # emit: symbols x states


def estimate(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
    """Parameters from expected counts; every symbol keeps some probability in every state."""
    emit = emit + 1e-3
    share = emit.sum(axis=1, keepdims=True) / emit.sum()
    emit = emit + 50.0 * share
    move = move + np.eye(len(move)) + 0.1
    start = start + 0.1
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _active(lens: np.ndarray) -> np.ndarray:
    """How many of the sequences (longest first) reach step t, for all t."""
    return np.searchsorted(-lens, -np.arange(lens[0]), side="left")


def forward(m: Model, flat: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """log10 likelihood of sequences flat[at:at+len], longest first, len > 0."""
    log = np.zeros(len(at))
    n = _active(lens)
    a = np.broadcast_to(m.start, (len(at), len(m.start)))
    for t in range(lens[0]):
        k = n[t]
        a = (a[:k] @ m.move if t else a[:k]) * m.emit[flat[at[:k] + t]]
        s = a.sum(axis=1)
        a = a / s[:, None]
        log[:k] += np.log10(s)
    return log


def expected(m: Model, sequences: list[np.ndarray], counts: list[np.ndarray]) -> None:
    """Adds the expected counts (start, move, emit) of whole sequences to ``counts``."""
    sequences = sorted((x for x in sequences if len(x)), key=len, reverse=True)
    if not sequences:
        return
    flat, lens = np.concatenate(sequences), np.array([len(x) for x in sequences])
    at = np.cumsum(lens) - lens
    n = _active(lens)
    ends = np.concatenate([[0], np.cumsum(n)])
    cuts = [0]
    while cuts[-1] < len(n):
        cuts.append(min(len(n), max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + WINDOW_CELLS, "right")) - 1)))

    def window(lo: int, hi: int, a: np.ndarray):
        """Symbols, emissions, forward vectors and scales of steps lo to hi; ``a``: the vectors of the step before."""
        first = np.repeat(ends[lo:hi], n[lo:hi])
        obs = flat[at[np.arange(ends[lo], ends[hi]) - first] + np.repeat(np.arange(lo, hi), n[lo:hi])]
        emit = np.take(m.emit, obs, axis=0, mode="clip")        # the quick way; no symbol is out of range
        alpha, scale = np.empty_like(emit), np.empty(len(obs))
        e = 0
        for t in range(lo, hi):
            k = n[t]
            here = alpha[e:e + k]
            if t:
                np.matmul(a[:k], m.move, out=here)
                here *= emit[e:e + k]
            else:
                np.multiply(a, emit[:k], out=here)
            here /= np.dot(here, ones, out=scale[e:e + k])[:, None]
            a, e = here, e + k
        return obs, emit, alpha, scale

    ones, onward = np.ones(len(m.start)), np.ascontiguousarray(m.move.T)
    borders = [np.broadcast_to(m.start, (len(at), len(m.start)))]
    for lo, hi in zip(cuts, cuts[1:]):
        made = window(lo, hi, borders[-1])
        borders.append(made[2][-n[hi - 1]:].copy())
    beta = np.ones((len(at), len(m.start)))
    move = np.zeros_like(m.move)
    for lo, hi, before in reversed(list(zip(cuts, cuts[1:], borders))):
        obs, emit, alpha, scale = made if hi == len(n) else window(lo, hi, before)
        emit /= scale[:, None]
        e = len(obs)
        for t in range(hi - 1, lo - 1, -1):
            k = n[t]
            if t:
                w = emit[e - k:e] * beta[:k]
                last = alpha[e - k - n[t - 1]:e - k] if t > lo else before
                move += last[:k].T @ w
                alpha[e - k:e] *= beta[:k]
                np.matmul(w, onward, out=beta[:k])
            else:
                alpha[:k] *= beta[:k]
                counts[0] += alpha[:k].sum(axis=0)
            e -= k
        for i in range(len(m.start)):
            counts[2][:, i] += np.bincount(obs, alpha[:, i], len(m.emit))
    counts[1] += move * m.move


def _zeros(size: int) -> list[np.ndarray]:
    return [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((size, STATES))]


def random_start(weight: np.ndarray) -> Model:
    """The symbol counts of the whole corpus, times a fixed random factor by symbol and state."""
    rng = np.random.default_rng(SEED)
    size = len(weight)
    return estimate(np.ones(STATES), 20.0 * np.eye(STATES), weight[:, None] * rng.uniform(0.05, 2.0, (size, STATES)))


def initial(sequences: list[np.ndarray], size: int) -> Model:
    """The training over a few sequences in memory: what the tests hold the distributed one against."""
    m = random_start(np.bincount(np.concatenate([np.empty(0, np.int64), *sequences]), minlength=size).astype(np.float64))
    for _ in range(PASSES):
        counts = _zeros(size)
        expected(m, sequences, counts)
        m = estimate(*counts)
    return m


def _pack(counts: list[np.ndarray]) -> pd.DataFrame:
    """Rows (symbol, expected counts by state) that occur; -1: start, -2-i: moves from state i."""
    seen = np.flatnonzero(counts[2].sum(axis=1) > 0)
    rows = np.concatenate([counts[2][seen], counts[0][None], counts[1]])
    frame = pd.DataFrame(rows, columns=[f"s{i}" for i in range(STATES)])
    frame.insert(0, "symbol", np.concatenate([seen, [-1], -2 - np.arange(STATES)]))
    return frame


_COLUMNS = "symbol long, " + ", ".join(f"s{i} double" for i in range(STATES))


def _unpack(rows: list, size: int) -> list[np.ndarray]:
    counts = _zeros(size)
    for symbol, *values in rows:
        if symbol >= 0:
            counts[2][symbol] = values
        elif symbol == -1:
            counts[0][:] = values
        else:
            counts[1][-2 - symbol] = values
    return counts


def packed(symbols: np.ndarray) -> bytes:
    return symbols.astype("<u2").tobytes()              # OWN + CLASSES + 1 at most


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2").astype(np.int64)


def baum_welch(train: DataFrame, size: int, m: Model) -> Model:
    """One round over all training texts (column ``symbols``): expected counts by task, summed by Spark."""
    model = ship(train, m)

    def make():
        counts, held = _zeros(size), []

        def learn_held():
            expected(model.value, [unpacked(t) for t in held], counts)
            held.clear()

        def add(columns, texts):
            held.extend(t for t in texts if len(t) > 2 * LONG_TEXT)
            if sum(map(len, held)) > HELD_BYTES:
                learn_held()
            short = [t for t in texts if len(t) <= 2 * LONG_TEXT]
            for lo, hi in slices(short, CHUNK_BYTES):
                expected(model.value, [unpacked(t) for t in short[lo:hi]], counts)
            return False

        def flush():
            learn_held()
            return {c: x.to_numpy() for c, x in _pack(counts).items()}
        return add, flush

    part = fold(train, make, _COLUMNS)
    total = part.groupBy("symbol").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(STATES)))
    return estimate(*_unpack([tuple(r) for r in total.collect()], size))      # size rows: OWN + CLASSES + 10 at most


def frequent_words(counts: DataFrame) -> Column:
    """Whether a word (word, c) is one of about KNOWN most frequent ones: by a histogram of bounded size, and
    where the words of its last step are too many, by their hashes."""
    step = F.when(F.col("c") < 1024, F.col("c")).otherwise(F.floor(F.pow(2.0, F.floor(F.log2("c") * 16) / 16))).cast("long")
    room, parts, short = KNOWN, 1 << 20, F.length("word") <= LONG
    found = F.lit(False)
    for r in sorted(counts.where(short).groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if r["n"] <= room:
            found, room = step >= F.lit(r["step"]), room - r["n"]
        else:
            found |= (step == F.lit(r["step"])) & (F.pmod(F.xxhash64("word"), F.lit(parts)) < int(room / r["n"] * parts))
            break
    return found & short


def learn(train: DataFrame, n_train: int) -> tuple[DataFrame, Symbols, Column]:
    """All counts (a table), the shipped symbols, and which words are in them."""
    counts = cut_lineage(count_tokens(train), "token-counts")
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    total, distinct = (sums[0] or 0) + n_train, sums[1] + (n_train > 0)
    known = frequent_words(counts)
    words = sorted(((bytes(r["word"]), r["c"]) for r in counts.where(known).collect()), key=lambda x: (-x[1], x[0]))
    classes = np.zeros((CLASSES, 2))
    by_class = F.crc32(F.expr("substring(word, -2)")) % CLASSES
    for r in counts.groupBy(by_class.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        classes[r["k"]] = r["c"], r["n"]
    for w, c in words[:OWN]:
        classes[class_of(w)] -= c, 1
    return counts, Symbols(words, classes, total, distinct), known


def encode(all_docs: DataFrame, symbols: Symbols, n_train: int) -> DataFrame:
    """Every text once, written: its symbols, what the word table says of it, and the words that are not in the table."""
    shipped = ship(all_docs, symbols)

    def make():
        s = shipped.value
        log_base = np.log10((s.counts + 0.5) / s.base_sum)
        end_base = float(np.log10((n_train + 0.5) / s.base_sum))
        within = np.array([0.0 if k < s.own else np.log10((c + 0.5) / s.class_sum[k - s.own])
                           for c, k in zip(s.counts, s.symbol)])
        within[-1] = log_base[-1] = 0.0                   # these come from the join
        known = s.counts > 0

        def work(columns, texts):
            out = {"row": columns[0], "doc_id": columns[1], "held_out": columns[2]}
            seq, n_tokens, n_known, base, inner, rare = [], [], [], [], [], []
            for t in texts:
                words = words_of(t)
                index, symbol, places = s.look_up(words)
                seq.append(packed(np.append(symbol, s.end)))
                n_tokens.append(len(words) + 1)
                n_known.append(int(known[index].sum()) + (n_train > 0))
                base.append(float(log_base[index].sum()) + end_base)
                inner.append(float(within[index].sum()))
                rare.append([words[i] for i in places])
            return out | {"n_tokens": n_tokens, "n_known": n_known, "base": base, "inner": inner, "rare": rare, "symbols": seq}
        return work

    rows = all_docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    return cut_lineage(scan(rows, make, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
                                        "inner double, rare array<binary>, symbols binary"), "encoded")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    all_docs = id_and_text(docs).withColumn("held_out", crc_remainder(F.col("doc_id"), 5) == 1)
    train = all_docs.where("not held_out").select("doc_id", "text")
    n_train = train.count()
    counts, symbols, known = learn(train, n_train)
    encoded = encode(all_docs, symbols, n_train)
    m = random_start(symbols.weight)
    for _ in range(PASSES if n_train else 0):
        m = baum_welch(encoded.where("not held_out").select("symbols"), symbols.size, m)
    model = ship(docs, m)
    kept = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner")

    def make():
        m = model.value

        def work(columns, texts):
            seq = [unpacked(t) for t in texts]
            lens = np.array([len(x) for x in seq])
            order = np.argsort(-lens, kind="stable")
            at = (np.cumsum(lens) - lens)[order]
            log = np.empty(len(seq))
            log[order] = forward(m, np.concatenate(seq), at, lens[order])
            return dict(zip(kept, columns)) | {"log": log}
        return work

    scored = scan(encoded.select(*kept, "symbols"), make,
                  "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, log double")
    others = counts.where(~known)
    sums = F.array(*(F.lit(float(x)) for x in symbols.class_sum))
    c = F.coalesce("c", F.lit(0))
    rare = (encoded.select("row", F.explode("rare").alias("word")).join(others, "word", "left")
            .select("row", (c > 0).cast("long").alias("known"), F.log10((c + 0.5) / F.lit(symbols.base_sum)).alias("base"),
                    F.log10((c + 0.5) / F.get(sums, F.crc32(F.expr("substring(word, -2)")) % CLASSES)).alias("inner"))
            .groupBy("row").agg(F.sum("known").alias("r_known"), F.sum("base").alias("r_base"), F.sum("inner").alias("r_inner")))
    zero = lambda x: F.coalesce(x, F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero(F.col("r_known"))).alias("n_known"),
        F.lit(symbols.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero(F.col("r_base"))).alias("base_score"), (F.col("log") + F.col("inner") + zero(F.col("r_inner"))).alias("score"))
