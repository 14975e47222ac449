"""Centroid clustering against a plain search over all distances."""

import math
import random
from hashlib import sha256

import numpy as np

from tierline.llm import centroids
from tierline.llm.common import table

from .cases import SF, by_id

NAMES = ("v", "cluster", "distance", "n", "total", "to_pivots")


def brute(data, k=16, rounds=3, size=64):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in data
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    most = centroids.MOST
    kept = [(i, [max(-most, min(most, x)) for x in v]) for i, v in kept]
    start = sorted(kept, key=lambda r: (sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in start]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in kept]
        if turn < rounds:
            for j in range(len(c)):
                of = [v for (_, v), (_, n) in zip(kept, near) if n == j]
                c[j] = [sum(col) // len(of) for col in zip(*of)] if of else c[j]
    cap = lambda x: min(x, centroids.MOST_LONG)
    sums = [sum(cap(d) for d, n in near if n == j) for j in range(len(c))]
    names = [sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, n, cap(d), cap(sums[n]), cap(sum(sums)), names[n]) for (i, _), (d, n) in zip(kept, near)), key=repr)


def frame(spark, data):
    return spark.createDataFrame([(i, v, *("x",) * len(NAMES)) for i, v in data],
                                 "vec_id long, embedding array<double>, " + ", ".join(f"{n} string" for n in NAMES))


def test_all_vectors(spark):
    found = table(spark, SF, "embeddings")
    data = [(r["vec_id"], r["embedding"]) for r in found.collect()]
    assert by_id(centroids.report(found)) == brute(data)


def test_odd_vectors(spark):
    rng = random.Random(3)
    point = lambda s=1.0: [rng.gauss(0, s) for _ in range(64)]
    data = [(i, point()) for i in range(60)] + [(60 + i, [0.25] * 64) for i in range(40)]          # a hot vector
    data += [(7, point()), (None, point()), (None, [0.25] * 64), (7, point())]                  # repeated and missing ids
    data += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [float("nan")] * 64),
             (205, [0.0] * 63 + [float("inf")]), (206, [0.0] * 63 + [None]), (207, [-0.0] * 64)]
    data += [(300 + i, [-1e-9 * i] * 64) for i in range(3)]
    assert by_id(centroids.report(frame(spark, data))) == brute(data)
    wide = data + [(400, [1e300] + [0.0] * 63), (401, [-3e7] * 64), (402, [2.0 ** 18] * 64)]      # beyond doubles, and beyond longs
    assert by_id(centroids.report(frame(spark, wide))) == brute(wide)
    few = data[:5]
    assert by_id(centroids.report(frame(spark, few))) == brute(few)
    assert by_id(centroids.report(frame(spark, [(1, None)]))) == []
    same = [(i, [0.5] * 64) for i in range(30)]                                                  # no two pivots apart
    assert by_id(centroids.report(frame(spark, same))) == brute(same)


def test_bounds_never_pass_the_distance_and_skip_work():
    rng = np.random.default_rng(1)
    middle = rng.integers(-40, 40, (16, 64))
    x = middle[rng.integers(0, 16, 3000)] + rng.integers(-6, 7, (3000, 64))
    pivots = centroids.Pivots(middle[:8].tolist())
    c = middle + rng.integers(-3, 4, middle.shape)
    bounds = pivots.bounds(pivots.distances(x), pivots.distances(c))
    exact = np.stack([centroids.squared(x, p) for p in c], axis=1)
    assert (bounds <= exact).all()
    on_line = np.outer(np.arange(-50, 50), np.ones(64, int))                                      # Ptolemy's bound is met exactly here
    line = centroids.Pivots([[0] * 64, [7] * 64])
    exact = np.stack([centroids.squared(on_line, p) for p in on_line], axis=1)
    assert (line.bounds(line.distances(on_line), line.distances(on_line)) <= exact).all()
    cluster, best, checked = centroids.nearest(x, pivots.distances(x), c, pivots)
    every = np.stack([centroids.squared(x, p) for p in c], axis=1)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert checked < 0.6 * len(x) * len(c)
