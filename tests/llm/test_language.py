"""Language profiles against a plain computation with Python integers."""

import math
from zlib import crc32

import numpy as np
import regex

from tierline.llm import language
from tierline.llm.common import table

from .cases import SF, by_id, empty, odd, rows

M64 = (1 << 64) - 1


def letter(point):
    """Signs of a letter, bit by bit."""
    out = []
    for k in range(language.DIM // 64):
        z = (point * (language.DIM // 64) + k + 1) * 0x9E3779B97F4A7C15 & M64
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & M64
        z = (z ^ z >> 27) * 0x94D049BB133111EB & M64
        z ^= z >> 31
        out += [1 - 2 * (b >> s & 1) for b in z.to_bytes(8, "little") for s in range(7, -1, -1)]
    return np.array(out)


def plain_bundle(text, known={}):  # noqa: B006
    total = np.zeros(language.DIM)
    for word in regex.findall(r"\p{L}+", (text or "").lower()):
        w = f" {word} "
        for k in range(len(w) - 2):
            if w[k:k + 3] not in known:
                a, b, c = (letter(ord(x)) for x in w[k:k + 3])
                known[w[k:k + 3]] = np.roll(a, 128) * np.roll(b, 64) * c
            total += known[w[k:k + 3]]
    return total


def brute(data):
    """data: (doc_id, text, lang)."""
    held = [crc32(("" if i is None else str(i)).encode()) % 4 == 2 for i, _, _ in data]
    learned = {}
    for (_, t, lang), out in zip(data, held):
        if lang is not None and not out:
            learned[lang] = learned.get(lang, 0) + plain_bundle(t)
    learned = {k: v for k, v in sorted(learned.items()) if v.any()}
    rows = []
    for (i, t, _), out in zip(data, held):
        v = plain_bundle(t)
        if not v.any() or not learned:
            rows.append((i, out, "und", 0.0))
            continue
        cos = {k: float(v @ p) / math.sqrt(float(v @ v) * float(p @ p)) for k, p in learned.items()}
        best = max(cos.values())
        rows.append((i, out, next(k for k in cos if cos[k] >= best - 1e-12), round(max(0.0, best), 9)))
    return sorted(rows, key=repr)


def got(df):
    return sorted(((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect()), key=repr)


def test_documents_and_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    data = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    found = got(language.identify(docs))
    assert found == brute(data)
    lang = {i: x for i, _, x in data}
    out = [(p, lang[i]) for i, held, p, _ in found if held and lang[i] is not None and p != "und"]
    assert len(out) > 20 and sum(p == x for p, x in out) >= 0.95 * len(out)


def odd_languages(spark):
    more = [(600 + i, t) for i, t in enumerate(["the cat sat on the mat", "der hund und die katze", "Der Hund", "le chat est là", "123 ² _ ½",
                                                "Ünïcödé ﬁ ß", "Добрый день", "добрый вечер", "漢字 かな", "a", "e" * 3000, "'"])]
    data = [(i, t, ("en", "de", None, "")[k % 4]) for k, (i, t) in enumerate(rows() + more)]
    docs = odd(spark, [(i, t) for i, t, _ in data])
    lang = spark.createDataFrame(data, "doc_id long, text string, lang string")
    return docs.unionByName(lang, allowMissingColumns=True).where("lang is not null or n is null"), data


def test_odd_cases_and_blocks_of_languages(spark):
    docs, data = odd_languages(spark)
    docs = docs.where("n is null")
    want = brute(data)
    assert got(language.identify(docs)) == want
    assert {"und", "en", "de", ""} == {r[2] for r in want}
    learned = language.prototypes(docs)
    assert [n for n, _ in language.blocks(learned, 2)] == [["", "de"], ["en"]]
    for size in (1, 2):
        assert got(language.predict(docs, learned, size)) == want
    assert by_id(language.identify(empty(spark).selectExpr("*", "'en' as lang"))) == []
    assert {r[2:] for r in by_id(language.identify(odd(spark).selectExpr("*", "cast(null as string) as lang")))} == {("und", 0.0)}


def test_long_texts_and_little_memory(monkeypatch):
    text = " ".join(f"{chr(97 + k % 26)}{chr(97 + k * 7 % 26)}{chr(97 + k // 26 % 26)}é" for k in range(3000)) + "日本" * 300
    whole = language.Bundler().of_text(text.encode())
    assert (whole == plain_bundle(text)).all()
    monkeypatch.setattr(language, "PART", 100)
    monkeypatch.setattr(language, "GRAMS", 64)
    assert (language.Bundler().of_text(text.encode()) == whole).all()
    assert "".join(language.parts(text)) == text and max(map(len, language.parts(text[:5000]))) < 200
