import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tierline.llm import queries, repeats
from tierline.llm.common import table

from .cases import SF, by_id, empty, odd, rows
from .test_scans import load


def brute(data, length):
    texts = [(t or "").encode() for _, t in data]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(data, texts):
        c = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                c[i:i + length] = True
        spans = int(c[:1].sum() + (c[1:] & ~c[:-1]).sum())
        out.append((doc, len(t), int(c.sum()), spans, sha256(np.frombuffer(t, np.uint8)[~c].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("q", [2, 3, 5, 7, 11])
def test_cover(q):
    v, d = q * q + q + 1, repeats.difference_cover(q)
    assert len(d) == q + 1 and {(a - b) % v for a in d for b in d} == set(range(v))


def test_documents(spark):
    assert by_id(repeats.remove_repeats(table(spark, SF, "documents"))) == brute(load(spark), 200)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", 3)       # more blocks than Spark allows by itself
    got = by_id(repeats.remove_repeats(table(spark, SF, "documents"), block_bytes=60_000, bucket_bytes=50_000))
    assert int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")) > 3
    spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert got == brute(load(spark), 200) and any(r[2] for r in got)


def test_odd_cases(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 9_000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 9_000)
    rng = random.Random(3)
    passage = "".join(rng.choice("abc ") for _ in range(60))
    data = rows() + [(600 + i, "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(90)))
                      + passage[rng.randrange(20):60 - rng.randrange(20)] * rng.randrange(1, 3)
                      + "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(90)))) for i in range(80)]
    for length in (12, 20, 45):
        assert by_id(repeats.remove_repeats(odd(spark, data), length)) == brute(data, length)
    assert by_id(repeats.remove_repeats(empty(spark))) == []


def test_both_names_decide():
    """Entries that share one of their two names only are different strings."""
    for stage, first in ((2, [5, 7, 7]), (3, [7, 7])):
        a, b = (np.array([*first, x], np.uint32).tobytes() for x in (1, 2))
        rows_of = lambda *data: pa.table({"block": list(range(len(data))), "payload": list(data)})
        work = repeats.owner_round(stage)
        bits = lambda *data: [x[0] & 1 for x in work((pa.scalar(0),), rows_of(*data))["bits"].to_pylist()]
        assert bits(a, b) == [0, 0] and bits(a, a) == [1, 1] and bits(a, b, a) == [1, 0, 1]
