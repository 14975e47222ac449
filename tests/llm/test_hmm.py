import re
from collections import Counter
from fractions import Fraction
from math import isclose, log10
from zlib import crc32

import numpy as np
import pytest

from tierline.llm import hmm, queries
from tierline.llm.common import table

from .cases import SF, empty, odd, rows
from .test_scans import load, lower

END = None


def base_brute(data):
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [END]) for i, t in data]
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
                   for i, ws in tokens), key=repr)


def same(got, want):
    got = sorted((tuple(r)[:6] for r in got), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


def test_base_scores(spark, monkeypatch):
    same(queries.op9_language_model(spark, SF).collect(), base_brute(load(spark)))
    monkeypatch.setattr(hmm, "KNOWN", 40)               # nearly all words come from the join
    monkeypatch.setattr(hmm, "OWN", 20)
    same(queries.op9_language_model(spark, SF).collect(), base_brute(load(spark)))
    same(hmm.score(odd(spark)).collect(), base_brute(rows()))
    assert hmm.score(empty(spark)).collect() == []
    same(hmm.score(odd(spark, [(1, "a b"), (1, None)])).collect(), base_brute([(1, "a b"), (1, None)]))


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    k, v = 3, 5
    m = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k).T)
    seqs = [rng.integers(0, v, n) for n in (6, 4, 1)]
    flat, lens = np.concatenate(seqs), np.array([6, 4, 1])
    got = hmm.forward(m, flat, np.cumsum(lens) - lens, lens)
    for s, g in zip(seqs, got):
        total = 0.0
        for path in np.ndindex(*(k,) * len(s)):
            p = m.start[path[0]]
            for t, state in enumerate(path):
                p *= m.emit[s[t], state] * (m.move[path[t - 1], state] if t else 1)
            total += p
        assert isclose(log10(total), g, rel_tol=1e-9)


def test_expected_counts_against_all_paths(monkeypatch):
    rng = np.random.default_rng(2)
    k, v = 2, 4
    monkeypatch.setattr(hmm, "STATES", k)
    m = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k).T)
    seqs = [rng.integers(0, v, n) for n in (5, 3, 7, 1)]
    got, want = hmm._zeros(v), hmm._zeros(v)
    hmm.expected(m, seqs, got)
    for s in seqs:
        each, total = hmm._zeros(v), 0.0
        for path in np.ndindex(*(k,) * len(s)):
            p = m.start[path[0]]
            for t, state in enumerate(path):
                p *= m.emit[s[t], state] * (m.move[path[t - 1], state] if t else 1)
            total += p
            each[0][path[0]] += p
            for t, state in enumerate(path):
                each[2][s[t], state] += p
                if t:
                    each[1][path[t - 1], state] += p
        for a, b in zip(want, each):
            a += b / total
    for a, b in zip(got, want):
        assert np.allclose(a, b)


def exact_counts(m, seq):
    """The sums over all paths of a text of any length, in rational numbers."""
    k = len(m.start)
    start, move, emit = ([[Fraction(float(x)) for x in row] for row in np.atleast_2d(t)] for t in (m.start, m.move, m.emit))
    ahead = [[start[0][i] * emit[seq[0]][i] for i in range(k)]]
    for o in seq[1:]:
        ahead.append([sum(ahead[-1][j] * move[j][i] for j in range(k)) * emit[o][i] for i in range(k)])
    behind = [[Fraction(1)] * k]
    for o in seq[:0:-1]:
        behind.insert(0, [sum(move[i][j] * emit[o][j] * behind[0][j] for j in range(k)) for i in range(k)])
    total = sum(ahead[-1])
    out = hmm._zeros(len(m.emit))
    out[0][:] = [float(a * b / total) for a, b in zip(ahead[0], behind[0])]
    for t, o in enumerate(seq):
        out[2][o] += [float(a * b / total) for a, b in zip(ahead[t], behind[t])]
        if t:
            out[1] += [[float(ahead[t - 1][i] * move[i][j] * emit[o][j] * behind[t][j] / total) for j in range(k)] for i in range(k)]
    return out, total


def test_expected_counts_of_long_texts(monkeypatch):
    """Texts of up to 300 tokens, whole: the same counts whatever the windows."""
    rng = np.random.default_rng(6)
    k, v = 2, 5
    monkeypatch.setattr(hmm, "STATES", k)
    m = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(v), k).T)
    seqs = [rng.integers(0, v, n) for n in (150, 300, 1, 129, 128, 129, 3)]
    want = hmm._zeros(v)
    for s in seqs:
        for a, b in zip(want, exact_counts(m, s)[0]):
            a += b
    for cells in (1, 7, 64, 1000, 1 << 19):
        monkeypatch.setattr(hmm, "WINDOW_CELLS", cells)
        got = hmm._zeros(v)
        hmm.expected(m, seqs, got)
        for a, b in zip(got, want):
            assert np.allclose(a, b, rtol=1e-9)
        assert isclose(got[1].sum(), sum(len(s) - 1 for s in seqs))                # no move is left out


def test_long_texts_are_held_back_not_left_out(spark, monkeypatch):
    monkeypatch.setattr(hmm, "PASSES", 2)
    monkeypatch.setattr(hmm, "LONG_TEXT", 20)
    monkeypatch.setattr(hmm, "HELD_BYTES", 500)
    made, learned, step = [], {}, hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda *a: made.append(step(*a)) or made[-1])
    monkeypatch.setattr(hmm, "learn", lambda *a, f=hmm.learn: learned.setdefault("all", f(*a)))
    texts = [(i, " ".join(f"w{(i * k) % 13}" for k in range(1 + 17 * i % 300))) for i in range(120)]
    hmm.score(spark.createDataFrame(texts, "doc_id long, text string"))
    s = learned["all"][1]
    train = [s.observations(t.encode()) for i, t in texts if crc32(str(i).encode()) % 5 != 1]
    want = hmm.initial(train, s.size)
    for a in ("start", "move", "emit"):
        assert np.allclose(getattr(made[-1], a), getattr(want, a), rtol=1e-6)


def test_score_end_to_end(spark, monkeypatch):
    """The column against a plain product of the model's numbers, with words in the table, in classes and in neither."""
    monkeypatch.setattr(hmm, "PASSES", 3)
    monkeypatch.setattr(hmm, "OWN", 6)
    monkeypatch.setattr(hmm, "KNOWN", 12)
    rng = np.random.default_rng(8)
    texts = [(i, " ".join(f"{'abc'[x % 3]}{x}" for x in (rng.pareto(0.8, rng.integers(0, 30)) * 3).astype(int) % 80)) for i in range(90)]
    texts += [(None, "a0 unseen"), (500, None), (501, "x" * 80 + " a0 " + "x" * 80)]
    learned, made, step = {}, [], hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda *a: made.append(step(*a)) or made[-1])
    monkeypatch.setattr(hmm, "learn", lambda *a, f=hmm.learn: learned.setdefault("all", f(*a)))
    got = {(r["doc_id"], r["n_tokens"]): r["score"] for r in hmm.score(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()}
    s, m = learned["all"][1], made[-1]
    assert 6 <= len(s.index) <= 20
    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 5 == 1
    c = Counter(w for i, t in texts if not held(i) for w in (t or "").encode().split())
    own = set(list(s.index)[:s.own])
    in_class = {}
    for w in c:
        if w not in own:
            in_class.setdefault(hmm.class_of(w), []).append(c[w])
    for i, t in texts:
        words = (t or "").encode().split()
        symbols = [s.index[w] if w in own else s.own + hmm.class_of(w) for w in words] + [s.end]
        ahead = m.start * m.emit[symbols[0]]
        for o in symbols[1:]:
            ahead = (ahead @ m.move) * m.emit[o]
        score = log10(ahead.sum())
        for w in words:
            if w not in own:
                mine = in_class.get(hmm.class_of(w), [])
                score += log10((c[w] + 0.5) / (sum(mine) + 0.5 * (len(mine) + 1)))
        assert isclose(got[i, len(words) + 1], score, rel_tol=1e-9), (i, t)


def test_words_that_all_occur_once_still_get_symbols(spark, monkeypatch):
    monkeypatch.setattr(hmm, "KNOWN", 100)
    counts = spark.range(3000).selectExpr("encode(concat('w', id), 'UTF-8') as word", "1L as c")
    assert 60 < counts.where(hmm.frequent_words(counts)).count() < 140
    more = counts.unionByName(spark.range(50).selectExpr("encode(concat('f', id), 'UTF-8') as word", "id + 2 as c"))
    known = more.where(hmm.frequent_words(more))
    assert known.where("c > 1").count() == 50 and 70 < known.count() < 130


def test_scores_beat_the_counts_and_sum_to_one(spark):
    got = hmm.score(table(spark, "/root/testdata/sf0.01", "documents")).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_word_probabilities_sum_to_one(spark, monkeypatch):
    """Over all known words, the end and the unknown word of every class, one step sums to 1."""
    monkeypatch.setattr(hmm, "OWN", 2)
    rng = np.random.default_rng(4)
    train = spark.createDataFrame([(i, " ".join(rng.choice(["aa", "bb", "cc", "dd", "xdd"], 6))) for i in range(40)], "doc_id long, text string")
    counts, s, _ = hmm.learn(train, 40)
    m = hmm.initial([s.observations(r["text"].encode()) for r in train.collect()], s.size)
    total = m.emit[:2].sum(axis=0) + m.emit[s.end]
    for k in range(hmm.CLASSES):
        mine = [r["c"] for r in counts.collect() if hmm.class_of(bytes(r["word"])) == k and s.index[bytes(r["word"])] >= 2]
        total = total + m.emit[2 + k] * (sum(c + 0.5 for c in mine) + 0.5) / s.class_sum[k]
    assert np.allclose(total, 1)


def test_every_round_reads_all_training_texts(spark, monkeypatch):
    """The distributed training is the one in memory over every training text, however many there are."""
    monkeypatch.setattr(hmm, "PASSES", 3)
    made, texts = [], [(i, f"tok{i % 7} tok{i % 11} mark{i} tok{i % 3}") for i in range(1700)]
    learned, step = {}, hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda *a: made.append(step(*a)) or made[-1])
    monkeypatch.setattr(hmm, "learn", lambda *a, f=hmm.learn: learned.setdefault("all", f(*a)))
    hmm.score(spark.createDataFrame(texts, "doc_id long, text string"))
    s = learned["all"][1]
    train = [s.observations(t.encode()) for i, t in texts if crc32(str(i).encode()) % 5 != 1]
    assert np.array_equal(s.weight, np.bincount(np.concatenate(train), minlength=s.size))
    want = hmm.initial(train, s.size)
    assert len(made) == hmm.PASSES
    for a in ("start", "move", "emit"):
        assert np.allclose(getattr(made[-1], a), getattr(want, a), rtol=1e-6)
    assert np.ptp(want.emit, axis=1).max() > 1e-3          # the states differ


def test_the_start_sets_states_apart_at_any_size():
    m = hmm.random_start(np.full(50, 1e15))                 # 100 TB and more
    assert (np.ptp(m.emit, axis=1) > 1e-3).any()
