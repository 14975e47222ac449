import re
from hashlib import sha256
from zlib import crc32

import pytest

from tierline.llm import decontaminate, exact, license, pieces, quality, queries, secrets
from tierline.llm.common import table

from .cases import SF, by_id, empty, odd, rows


def load(spark, name="documents"):
    return [(r[0], r[1]) for r in table(spark, SF, name).select(*(("item_id", "text") if name == "benchmark" else ("doc_id", "text"))).collect()]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- op8 ------------------------------------------------------------------
def exact_brute(data):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in data]
    out = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_odd_cases(spark):
    assert by_id(exact.find_duplicates(odd(spark))) == exact_brute(rows())
    assert by_id(exact.find_duplicates(empty(spark))) == []


def test_exact_with_colliding_hashes_and_doubling(spark):
    from pyspark.sql import functions as F
    weak = exact.find_duplicates(odd(spark), hash_fn=lambda t: F.shiftleft(F.length(t).cast("long") % 7, 58), bucket_entries=3)
    assert by_id(weak) == exact_brute(rows())


def test_exact_directory_splits_only_overfull_buckets(spark):
    """A skewed hash: most hashes share 20 leading bits, others are spread; one hash alone is too much for a bucket."""
    import random
    rng = random.Random(2)
    top = lambda x: x - (1 << 64) if x >> 63 else x
    hashes = {top((0xABCDE << 44) + rng.getrandbits(44)): 1 for _ in range(900)} | {top(rng.getrandbits(64)): 1 for _ in range(300)} | {77: 500}
    got = exact.directory(spark.createDataFrame(list(hashes.items()), "h long, weight long"), 40).orderBy("bucket").collect()
    held = {r["bucket"]: [h for h in hashes if r["depth"] == 0 or (h % (1 << 64)) >> (64 - r["depth"]) == r["prefix"]] for r in got}
    assert sorted(h for hs in held.values() for h in hs) == sorted(hashes)                 # each hash in one bucket
    assert all(r["weight"] == sum(hashes[h] for h in held[r["bucket"]]) for r in got)
    assert all(r["weight"] <= 40 or len(held[r["bucket"]]) == 1 for r in got)
    for r in got:                                                                          # every split was of an overfull bucket
        up = sum(w for h, w in hashes.items() if (h % (1 << 64)) >> (65 - r["depth"]) == r["prefix"] >> 1)
        assert up > 40
    assert len({r["depth"] for r in got}) > 5 and max(r["depth"] for r in got) > 20
    first = [min((h % (1 << 64)) for h in held[r["bucket"]]) for r in got]
    owners = [r["owner"] for r in got]
    assert first == sorted(first) and owners == sorted(owners) and len(set(owners)) > 10     # owners have ranges of hashes
    few = exact.directory(spark.createDataFrame([(5, 3), (-5, 3)], "h long, weight long"), 40).collect()
    assert [(r["depth"], r["prefix"], r["weight"]) for r in few] == [(0, 0, 6)]


@pytest.mark.parametrize("bucket_entries", [3, 50, 100_000])
def test_exact_with_skewed_hashes_and_hot_copies(spark, bucket_entries):
    """Few leading bits, colliding chains, copies above and below the mark for hot ones."""
    from pyspark.sql import functions as F
    data = rows() + [(1000 + i, "hot \t copy") for i in range(300)] + [(None, "hot copy")] + [(2000 + i, f"t{i % 90}") for i in range(200)]
    for hash_fn in (lambda t: F.shiftrightunsigned(F.xxhash64(t), 20), lambda t: F.pmod(F.xxhash64(t), F.lit(5)), lambda t: F.lit(-1).cast("long")):
        assert by_id(exact.find_duplicates(odd(spark, data), hash_fn, bucket_entries)) == exact_brute(data)


def test_exact_index_lines_come_from_chains(spark):
    """One line a text, in the bucket of its hash, also where all texts share a hash."""
    from pyspark.sql import functions as F
    base = odd(spark).select("doc_id", exact.normalised(F.col("text")).alias("text")).withColumn("h", F.pmod(F.xxhash64("text"), F.lit(3)))
    lines = base.select("doc_id", "h", exact.digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"))
    index = exact.build_index(base, lines, 4).collect()
    texts = {t for _, t in base.select("h", "text").collect()}
    assert len(index) == len(texts) and sum(r["group_size"] for r in index) == len(rows())
    assert len({(r["bucket"], r["h"]) for r in index}) == 3 < len(index)


def test_exact_on_documents(spark):
    assert by_id(queries.op8_exact_dedup(spark, SF)) == exact_brute(load(spark))
    kept = by_id(exact.unique_rows(table(spark, SF, "documents")).select("doc_id"))
    assert kept == sorted(((r[0],) for r in exact_brute(load(spark)) if r[3]), key=repr)


# ---- op4 ------------------------------------------------------------------
def license_brute(data):
    out = []
    for i, t in data:
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        starts, labels = [], set()
        for phrase, label in license.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        out.append((i, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_license_base(spark, source):
    docs, data = (odd(spark), rows()) if source == "odd" else (table(spark, SF, "documents"), load(spark))
    got = license.scan_licenses(docs)
    assert by_id(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == license_brute(data)
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert by_id(license.scan_licenses(empty(spark))) == []


def test_template_markup():
    a = license.compile_template("one [[two [[three]]]] <<1-2>> four")
    yes = ["one x four", "one two x four", "one two three x y four", "one x y four"]
    no = ["one four", "one three x y z four", "two x four", "one two three x y z four", "one x y"]
    assert all(a.longest(t.encode().split(), 0) == len(t.split()) for t in yes)
    assert all(a.longest(t.encode().split(), 0) == -1 for t in no)
    with pytest.raises(ValueError):
        license.compile_template("one [[two")


# ---- op5 ------------------------------------------------------------------
def secrets_brute(data):
    letters = {c: f"[{c}{c.upper()}]" for c in "abcdefghijklmnopqrstuvwxyz"}
    key = "|".join("".join(letters.get(c, c) for c in w) for w in ("password", "passwd", "secret", "token"))
    api = "".join(letters[c] for c in "api") + "_?" + "".join(letters[c] for c in "key")
    forms = [("assign", re.compile(rf"""({key}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(2)) >= 6),
             ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24)]
    out = []
    for i, t in data:
        found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(forms) for m in p.finditer(t or "") if ok(m))
        text = ",".join(f"{forms[k][0]}:{s}:{e}" for s, k, e in found)
        out.append((i, *(sum(f[1] == k for f in found) for k in range(3)), sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_secret_base(spark, source):
    docs, data = (odd(spark), rows()) if source == "odd" else (table(spark, SF, "documents"), load(spark))
    got = secrets.scan_secrets(docs)
    assert by_id(got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")) == secrets_brute(data)
    for r in got.collect():
        base = [s for s in r["spans"].split(",") if s and not s.startswith("entropy")]
        assert sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
    assert by_id(secrets.scan_secrets(empty(spark))) == []


def test_entropy_matches_a_plain_computation():
    from collections import Counter
    from math import log2
    text = "x zX9kQ2vB7nM4pL1sT6wR3yH8aaaaaaaaaaaaaaaaaaaaaaaaaazX9kQ2vB7nM4pL1sT6wR3yH8 y"
    s, off = text[2:-2], 2
    flagged = set()
    for i in range(len(s) - secrets.WINDOW + 1):
        c = Counter(s[i:i + secrets.WINDOW]).values()
        if -sum(n / secrets.WINDOW * log2(n / secrets.WINDOW) for n in c) >= secrets.THRESHOLDS["alnum"]:
            flagged |= set(range(off + i, off + i + secrets.WINDOW))
    got = secrets.entropy_spans(text, [], secrets.THRESHOLDS)
    assert {p for a, b in got for p in range(a, b)} == flagged and len(got) == 2
    assert secrets.entropy_spans("123e4567-e89b-12d3-a456-426614174000", [re.compile(p) for p in secrets.ALLOWED], secrets.THRESHOLDS) == []


# ---- op7 ------------------------------------------------------------------
def leak_brute(data, items):
    pat = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wins = {}
    for i, t in items:
        w = re.findall(pat, lower(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    out = []
    sizes = {len(w) for w in wins}
    for i, t in data:
        w = re.findall(pat, lower(t))
        hit, ids = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[k:k + n]))):
                    hit |= set(range(k, k + n))
                    ids |= got
        out.append((i, len(w), len(hit), len(ids), sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_decontamination(spark, monkeypatch):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    brute = leak_brute(load(spark), load(spark, "benchmark"))
    assert any(r[5] for r in brute)
    assert by_id(decontaminate.report(docs, items).select(*COLS)) == brute
    clean = by_id(decontaminate.clean(docs, items).select("doc_id"))
    assert clean == sorted(((r[0],) for r in brute if not r[5]), key=repr)
    monkeypatch.setattr(decontaminate.groups, "__defaults__", (3000,))      # several automata
    assert by_id(decontaminate.report(docs, items).select(*COLS)) == brute


def test_decontamination_odd_cases(spark):
    bench = [(1, "A b, c d e f g h i j k l"), (2, "one"), (3, None), (4, ""), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (5, "mit license"), (None, "x")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = leak_brute(rows(), [b for b in bench if b[0] is not None])
    assert by_id(decontaminate.report(odd(spark), items).select(*COLS)) == want
    assert not any(r[5] for r in by_id(decontaminate.report(odd(spark), items.limit(0)).select(*COLS)))
    assert by_id(decontaminate.report(empty(spark), items)) == []
    text = "é A, b; c D e f g h i j — z"
    one = decontaminate.report(odd(spark, [(1, text)]), items).first()["hit_spans"]
    s, e = map(int, one.split(":"))
    assert text[s:e] == "A, b; c D e f g h i j"


# ---- op10 -----------------------------------------------------------------
def viterbi_brute(word, v):
    """Any piece at any place."""
    pieces_of = {**v.body, **v.head, **{"▁" * n: x for n, x in v.runs.items()}}
    best = {0: (0.0, ())}
    for j in range(1, len(word) + 1):
        got = []
        for i in range(j):
            hit = pieces_of.get(word[i:j])
            if hit:
                got.append((best[i][0] + hit[0], best[i][1] + (hit[1],)))
        if word[j - 1] not in pieces_of:
            raw = ("▁" if word[j - 1] == pieces.LITERAL else word[j - 1]).encode()
            got.append((best[j - 1][0] + v.byte_score * len(raw), best[j - 1][1] + tuple(v.byte_ids[b] for b in raw)))
        best[j] = max(got, key=lambda x: x[0])
    return best[len(word)]


def score_of(ids, v):
    flat = {i: s for d in (v.head, v.body, v.runs) for s, i in d.values()}
    return sum(flat.get(i, v.byte_score) for i in ids)


def test_pieces_of_blanks_and_long_units(monkeypatch):
    """Runs of blanks use their pieces, alone and before a word; units of any length give the best path part by part."""
    import random
    v, rng = pieces.load(), random.Random(4)
    assert sorted(v.runs) == [*range(1, 15), 16] and all(i in v.spelling for _, i in v.runs.values())
    texts = ["    indented", "a  b   c", "  ", " ", "x " * 3 + " " * 40 + "y", "▁ ▁▁a ▁", "tab\t  \n  end ", " " * 100, "日本語" * 40, "a▁b  ▁"]
    texts += ["".join(rng.choice(["  ", " ", "the", "ab", "日", "▁", "e", "\n", "ing"]) for _ in range(60)) for _ in range(40)]
    for t in texts:
        units = pieces.words_of(t.encode())
        assert "".join(units).replace("▁", " ").replace(pieces.LITERAL, "▁") == " " + t
        whole = "".join(units)
        ids = pieces.Encoder(v).encode([t.encode()])[0]
        assert abs(score_of(ids, v) - viterbi_brute(whole, v)[0]) < 1e-6        # the best units are the best text
        assert pieces.decode_ids(ids, v) == t.encode()
        for n in (1, 3, 20, 64):
            monkeypatch.setattr(pieces, "LONG_UNIT", n)
            for u in units:
                assert abs(score_of(pieces.segment_long(u, v), v) - score_of(pieces.segment([u], v)[u], v)) < 1e-6
            assert pieces.decode_ids(pieces.Encoder(v).encode([t.encode()])[0], v) == t.encode()
    assert len(pieces.Encoder(v).encode([b" " * 40 + b"x"])[0]) <= 5


def test_pieces_memory(monkeypatch):
    """Texts without blanks: neither the units remembered nor the search grow with what has gone by."""
    import random
    import tracemalloc
    v, rng = pieces.load(), random.Random(4)
    e, peaks = pieces.Encoder(v), []
    monkeypatch.setattr(pieces, "CACHE_BYTES", 1 << 20)
    monkeypatch.setattr(pieces, "LONG_UNIT", 5000)
    text = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n)).encode()
    for _ in range(3):
        tracemalloc.start()
        for _ in range(30):
            assert pieces.decode_ids(e.encode([t := text(1500)])[0], v) == t
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert e.size <= 1 << 20 and e.size >= sum(len(w) for w in e.known)
    assert max(peaks) < 12 << 20
    tracemalloc.start()
    t = text(60_000)
    ids = e.encode([t])[0]
    assert pieces.decode_ids(ids, v) == t and not any(len(w) > 5000 for w in e.known)
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.stop()


def test_pieces(spark):
    v = pieces.load()
    words = sorted({w for _, t in rows() + load(spark)[:20] for w in pieces.words_of((t or "").encode()) if len(w) < 200})
    got = pieces.segment(words, v)
    for w in words:
        assert abs(score_of(got[w], v) - viterbi_brute(w, v)[0]) < 1e-6
    for docs, data in ((odd(spark), rows()), (table(spark, SF, "documents"), load(spark))):
        enc = pieces.encode(docs)
        assert enc.where("not round_trip").count() == 0
        assert by_id(enc.select("doc_id", "decoded_sha256")) == sorted(((i, sha256((t or "").encode()).hexdigest()) for i, t in data), key=repr)
        assert by_id(pieces.decode(enc)) == sorted(((i, t or "") for i, t in data), key=repr)
    assert by_id(pieces.encode(empty(spark))) == []


# ---- op3 ------------------------------------------------------------------
def test_quality(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    w = quality.train(docs, labels)
    got = {r["doc_id"]: r for r in quality.score(docs, w).collect()}
    truth = [(r["doc_id"], r["quality"]) for r in labels.collect()]
    assert all(got[i]["held_out"] == (crc32(str(i).encode()) % 4 == 2) for i, _ in truth)
    held = [(got[i]["predicted"], q) for i, q in truth if got[i]["held_out"]]
    assert len(held) > 20 and sum(p == q for p, q in held) / len(held) >= 0.95
    kept = {r[0] for r in quality.accepted(docs, w).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}


def test_quality_odd_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, None, 0), (None, 1, 0), (6, 1, 0), (777, 1, 0)], "doc_id long, quality int, toxic int")
    w = quality.train(odd(spark), labels)
    got = quality.score(odd(spark), w).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.score(odd(spark), quality.train(odd(spark), labels.limit(0))).collect()
    assert {r["score"] for r in none} == {0.5} and {r["predicted"] for r in none} == {0}
    assert quality.score(empty(spark), w).collect() == []
    assert quality.accepted(odd(spark), w).columns == odd(spark).columns


def test_sql_agrees(spark):
    """The queries that have SQL, against DuckDB on the same table."""
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    for key, sql in queries.oracle_sql().items():
        got = queries.queries()[key](spark, SF)
        want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({sql})").fetchall()
        assert by_id(got) == sorted(want, key=repr)
