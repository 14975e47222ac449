import re
from collections import Counter
from hashlib import sha256
from math import log
from time import time

from tierline.llm import near, pii, queries
from tierline.llm.common import table

from .cases import SF, by_id, empty, odd, rows
from .test_scans import load, lower


# ---- op6 ------------------------------------------------------------------
def near_brute(data, width, threshold=80):
    sets = []
    for i, t in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1)) if w))
    known = sorted({i for i, _ in data if i is not None})
    root = {i: i for i in known}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        if data[k][0] is None:
            continue
        for j in {j for x in s for j in where[x] if j < k and data[j][0] is not None}:
            both = len(s & sets[j])
            if 100 * both >= threshold * len(s | sets[j]):
                a, b = find(data[k][0]), find(data[j][0])
                root[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(data, sets)), key=repr)


def test_near_on_documents(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = table(spark, sf, "documents")
        data = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
        assert by_id(queries.op6_minhash(spark, sf)) == near_brute(data, 4)


def test_near_odd_cases_and_a_chain(spark):
    # a chain: neighbours are similar, the ends are not; and near copies around one original
    chain = [(300 + i, " ".join(f"c{k}" for k in range(4 * i, 4 * i + 100))) for i in range(12)]
    star = [(400 + i, " ".join(f"s{k}" if k != 3 * i else "changed" for k in range(100))) for i in range(25)]
    data = [r for r in rows()] + chain + star
    for width in (4, 5):
        assert by_id(near.find_near_duplicates(odd(spark, data), width)) == near_brute(data, width)
    assert by_id(near.find_near_duplicates(empty(spark))) == []
    docs = odd(spark, data)
    stay = near.representatives(docs)
    assert stay.columns == docs.columns
    assert by_id(stay.select("doc_id")) == sorted(((r[0],) for r in near_brute(data, near.WIDTH) if r[3]), key=repr)


def test_components(spark):
    import random
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = dict(by_id(near.components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {i: find(i) for i in root}


# ---- op1 ------------------------------------------------------------------
def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii_brute(data):
    digits = lambda s: re.sub("[^0-9]", "", s)
    forms = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)]
    out = []
    for i, t in data:
        found = [[(m.start(), m.end()) for m in re.finditer(p, t or "") if ok(m.group())] for _, p, ok in forms]
        text = ",".join(f"{f[0]}:{s}:{e}" for f, xs in zip(forms, found) for s, e in xs)
        out.append((i, *map(len, found), sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


PII = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
HARD = ["1.2.3.4.5.6.7.8 1.2.3.4.5 256.1.1.1.1 0001.2.3.004", "a@b.c+d@e.f,g@h-i.j.k. @x.y a@b a@b..c a@.b",
        "4111-1111 1111 1111 4111  1111 1111 1111 1111 41111111111111111111", "4111 1111 1111 1111 1", "5555555555554444 4",
        "+1 2 3 +49 (0) 30.123-456 +12345678901234567890 +1+2345678 + 1 +1(", "é@x.y über.mail@dömain.de x@y.z",
        "9 " * 30000, "1." * 20000, "a" * 30000 + "@", "x@" + "a." * 3000 + "b", "+" + "1" * 20000, "4111111111111111", "4111111111111112"]


def test_pii_base(spark):
    data = rows() + [(500 + k, t) for k, t in enumerate(HARD)]
    got = pii.report(odd(spark, data))
    assert by_id(got.select(*PII)) == pii_brute(data)
    docs = table(spark, SF, "documents")
    got = queries.op1_pii(spark, SF)
    assert by_id(got.select(*PII)) == pii_brute(load(spark))
    for r in got.collect():
        base = [s for s in r["spans"].split(",") if s and s.split(":")[0] in pii.KINDS[:4]]
        assert sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
    assert by_id(pii.report(empty(spark))) == []
    assert docs.count() == got.count()


def test_pii_terms(spark):
    common = "some common words stand here and there in every text of this corpus"
    data = [(i, f"{common} number{i}") for i in range(40)]
    data += [(100 + i, f"{common}; contact Zebulon at zeb@corp.example please {common}") for i in range(3)]
    data += [(200, f"{common} write once to solo@corp.example from Nowhere")]
    got = {r["doc_id"]: r["spans"] for r in pii.report(odd(spark, data)).collect()}
    text = dict(data)[100]
    words = {text[int(s):int(e)].lower(): k for k, s, e in (x.split(":") for x in got[100].split(","))}
    assert words["zeb@corp.example"] == "email" and words["zebulon"] == "removed"
    assert "common" not in words and "corpus" not in words
    assert all(x.startswith("email") for x in got[200].split(","))          # one document proves nothing
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(odd(spark, data)).collect()}
    assert "zeb" not in clean[100].lower() and "<email>" in clean[100] and clean[5] == dict(data)[5] and len(clean) == len(data)


def test_pii_terms_of_the_whole_text(spark):
    """A revealing term far from its entity counts, and goes wherever it stands in the text."""
    common = "some common words stand here and there in every text of this corpus "
    data = [(i, common + f"number{i}") for i in range(40)]
    data += [(100 + i, f"Zebulon; {common * 3} zeb@corp.example zebulon2 {common * 3} ZEBULON, zeb@corp.example.zebulon") for i in range(3)]
    found = {r["doc_id"]: r for r in pii.report(odd(spark, data)).collect()}
    text = dict(data)[100]
    got = [(k, text[int(s):int(e)]) for k, s, e in (x.split(":") for x in found[100]["spans"].split(","))]
    assert got == [("email", "zeb@corp.example"), ("email", "zeb@corp.example.zebulon"),
                   ("removed", "Zebulon"), ("removed", "zebulon"), ("removed", "ZEBULON")]
    assert found[100]["n_removed"] == 3 and found[5]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(odd(spark, data)).collect()}
    assert "zebulon" not in clean[101].lower() and clean[101].count("common") == 6


def test_pii_counts_every_document_with_the_entity(spark):
    """Documents without any term beside the entity, rows without id and repeated rows all count in n_e and n_te."""
    data = [(i, f"filler text number {i}") for i in range(400)]
    data += [(1000 + i, f"10.0.0.1 {i}") for i in range(100)]              # no term at all
    data += [(2000 + i, "10.0.0.1 gateway") for i in range(3)] + [(3000 + i, "the gateway") for i in range(3)]
    data += [(None, f"Zebulon at zeb@corp.example {'x' * k}") for k in range(3)]
    got = {}
    for r in pii.report(odd(spark, data)).collect():
        got.setdefault(r["doc_id"], []).append(r["spans"])
    # n_e is 103 of 509: 1 + ln(3/6) / ln(509/103) = 0.57, not 1 + ln(3/6) / ln(509/3) = 0.87
    assert got[2000] == ["ip:0:8"]
    assert all("removed:0:7" in x for x in got[None]) and len(got[None]) == 3


def test_pii_judges_an_entity_of_one_document(spark):
    """1 - ln(3.5) / ln(N) from GENERALISE on: what stands in one document only is judged as well."""
    data = [(i, f"common filler text number {i}") for i in range(2000)]
    data += [(5000, "common text by Zebulon, zeb@corp.example")]
    found = {r["doc_id"]: r for r in pii.report(odd(spark, data)).collect()}
    assert found[5000]["spans"] == "email:24:40,generalised:15:22" and found[7]["spans"] == ""


def terms_brute(data):
    """(row number, term) -> (largest share, n_t), over all pairs of every text."""
    digits = lambda x: re.sub("[^0-9]", "", x)
    forms = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda x: True, str.lower),
             (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", lambda x: all(int(p) <= 255 for p in x.split(".")), lambda x: ".".join(str(int(p)) for p in x.split("."))),
             (r"[0-9](?:[\x20-]?[0-9])+", lambda x: 16 <= len(digits(x)) <= 19 and luhn(digits(x)), digits),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 8 <= len(digits(x)) <= 15, digits)]
    rows = []
    for _, t in data:
        t = t or ""
        found = [(k, m) for k, (p, ok, _) in enumerate(forms) for m in re.finditer(p, t) if ok(m.group())]
        chars = list(t.replace("\x01", " "))
        for _, m in found:
            chars[m.start():m.end()] = "\x01" * (m.end() - m.start())
        words = re.findall(r"(?<![\x01A-Za-z\x80-\U0010ffff])[A-Za-z\x80-\U0010ffff]{4,}(?![\x01A-Za-z\x80-\U0010ffff])", "".join(chars))
        rows.append(({(k, forms[k][2](m.group())) for k, m in found}, {w.lower() for w in words}))
    n, n_t = len(rows), Counter(w for _, words in rows for w in words)
    n_e, n_te = Counter(e for found, _ in rows for e in found), Counter((e, w) for found, words in rows for e in found for w in words)
    best = {}
    for (e, w), c in n_te.items():
        if n_e[e] < n:
            best[e, w] = log(c ** 3 / (c * c + pii.SHRINK) * n / (n_t[w] * n_e[e])) / log(n / n_e[e])
    out = {}
    for k, (found, words) in enumerate(rows):
        for w in words:
            top = max((best[e, w] for e in found if (e, w) in best), default=0)
            if top >= pii.GENERALISE:
                out[k, w] = (round(top, 9), n_t[w])
    return out


def test_pii_pairs_against_all_pairs(spark):
    import random
    rng = random.Random(11)
    data = rows() + [(None, "Zebulon zeb@corp.example"), (5, "Zebulon zeb@corp.example")]
    for i in range(400):
        words = [f"word{chr(97 + int(26 * rng.random() ** 3))}{chr(97 + int(9 * rng.random() ** 2))}" for _ in range(rng.randrange(1, 30))]
        if rng.random() < 0.4:
            k = int(20 * rng.random() ** 2)
            words += [f"user{k}@corp.example", f"friend{chr(97 + k)}x"] * rng.randrange(1, 3)
        if rng.random() < 0.2:
            words += [f"10.0.{int(4 * rng.random())}.0{rng.randrange(3)}", "gateway"]
        if rng.random() < 0.1:
            words += ["+49 30 1234 567", "4111 1111 1111 1111", "dial"]
        data.append((1000 + i, " ".join(rng.sample(words, len(words)))))
    docs = odd(spark, data).coalesce(1)                       # rows are numbered in their order
    found = pii.disclosing_terms(docs, pii.scanned(docs)).collect()
    got = {(r["row"], r["term"]): (round(r["share"], 9), r["n_t"]) for r in found}
    want = terms_brute(data)
    assert got == want and len(want) > 150 and len(found) == len(got)
    assert len({r["n_te"] for r in found}) > 3 and min(r["n_e"] for r in found) == 1 < max(r["n_e"] for r in found)


def test_pii_entities_by_kind(spark):
    """An IP address keeps its dots, a card does not keep its blanks; a name counts the same in all texts, addresses aside."""
    common = "some common words stand here and there"
    data = [(i, f"{common} number{i}") for i in range(40)] + [(100 + i, f"{common} Zebulon 10.0.0.255") for i in range(3)]
    more = [(300 + i, f"{common} 100.0.2.55") for i in range(100)]
    kinds = [{r["doc_id"]: r["spans"] for r in pii.report(odd(spark, x)).collect()}[100] for x in (data, data + more)]
    assert all(x.split(",")[1].startswith("removed") for x in kinds)
    named = [(300 + i, f"{common} zebulon@corp{i}.example") for i in range(60)]
    assert "removed" in {r["doc_id"]: r["spans"] for r in pii.report(odd(spark, data + named)).collect()}[100]
    cards = [(100, f"{common} Yolanda 4111 1111 1111 1111"), (101, f"{common} Yolanda 4111111111111111"), (102, f"{common} Yolanda 4111-1111-1111-1111")]
    rows_of = pii.scanned(odd(spark, cards)).select("entities").collect()
    assert len({bytes(r[0][0]) for r in rows_of}) == 1
    assert pii.scanned(odd(spark, cards)).schema["base"].dataType.elementType.names == ["k", "s", "e"]      # no values are written


def test_pii_long_lists(spark):
    """1,600 addresses and 6,400 words in one text, its copy, and 8,000 addresses in another: no pair of all with all."""
    letters = lambda k: "".join(chr(97 + k // 26 ** j % 26) for j in range(4))
    one = " ".join(f"{letters(4 * k)} {letters(4 * k + 1)} {letters(4 * k + 2)} {letters(4 * k + 3)} u{k}@corp.example" for k in range(1600))
    data = [(i, f"common filler text number {i}") for i in range(2000)]
    data += [(5000, one), (5001, one), (5002, " ".join(f"v{k}@corp.example" for k in range(8000)))]
    docs = odd(spark, data)
    pii.report(docs.limit(50)).collect()
    began = time()
    found = {r["doc_id"]: r for r in pii.report(docs).collect()}
    took = time() - began
    assert found[5000]["n_email"] == 1600 and found[5002]["n_email"] == 8000
    assert found[5000]["n_removed"] + found[5000]["n_generalised"] == 6400 and found[5000]["spans"] == found[5001]["spans"]
    assert took < 30, took
