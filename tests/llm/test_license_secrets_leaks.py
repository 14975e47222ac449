"""The methods' own finds of the licence, secret and benchmark scans, against plain versions."""

import random
import re
from collections import Counter
from functools import cache
from math import log2
from time import time

import pytest

from tierline.llm import decontaminate, license, queries, secrets
from tierline.llm.common import table

from .cases import SF, by_id, odd
from .test_scans import leak_brute, load, lower


# ---- op4 ------------------------------------------------------------------
@cache
def as_regex(markup):
    """A template as a pattern over words, each with a blank after it."""
    out = []
    for t in re.findall(r"\[\[|\]\]|<<\d+-\d+>>|[^\s\[\]<>]+", markup):
        low_high = re.fullmatch(r"<<(\d+)-(\d+)>>", t)
        out.append("(?:" if t == "[[" else ")?" if t == "]]" else
                   rf"(?:\S+ ){{{low_high[1]},{low_high[2]}}}" if low_high else re.escape(t) + " ")
    return re.compile("".join(out))


def labels_brute(text, templates):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    joined = " ".join(words) + " "
    starts = [0, *(m.end() for m in re.finditer(" ", joined))][:len(words)]
    return {label for label, xs in templates.items() for x in ((xs,) if isinstance(xs, str) else xs)
            if any(as_regex(x).match(joined, k) for k in starts)}


def filled(markup, rng):
    """A text that the markup accepts."""
    markup = re.sub(r"<<(\d+)-(\d+)>>", lambda m: " ".join(["filler"] * rng.randint(int(m[1]), int(m[2]))), markup)
    while "[[" in markup:
        markup = re.sub(r"\[\[([^\[\]]*)\]\]", lambda m: m[1] if rng.random() < 0.5 else "", markup)
    return " ".join(markup.split())


def test_whole_licences_and_changed_ones(spark):
    rng = random.Random(1)
    texts, want = [], []
    for label, xs in license.TEMPLATES.items():
        for x in (xs,) if isinstance(xs, str) else xs:
            for _ in range(3):
                text = filled(x, rng)
                texts.append(f"Preface. {text.capitalize()}. Then more")
                want.append((label, True))
                mandatory = [w.decode() for w in license.compile_template(x).mandatory]
                word = rng.choice(mandatory[1:])
                texts.append(f"Preface. {re.sub(rf'(?<!\\S){word}(?!\\S)', 'changed', text)}. Then more")
                want.append((label, False))
    got = [set(r["labels"].split(",")) for r in license.scan_licenses(odd(spark, list(enumerate(texts))).coalesce(1)).orderBy("doc_id").collect()]
    for text, labels, (label, there) in zip(texts, got, want):
        assert (label in labels) == there, (label, text)
        assert labels - set(license.BASE.values()) - {""} == labels_brute(text, license.TEMPLATES) - set(license.BASE.values()), text


def test_license_cases(spark):
    bsd = filled(license.TEMPLATES["bsd-2-text"], random.Random(2))
    data = ["subject to the terms of the Mozilla Public License, version 2.0", "subject to the terms of the Mozilla Public License, v. 2.0",
            "subject to the terms of the Mozilla Public License, v ersion 2 0", bsd, bsd.replace("binary form must", "binary form need not"), bsd[:200]]
    got = {r["doc_id"]: r["labels"] for r in license.scan_licenses(odd(spark, list(enumerate(data)))).collect()}
    assert [got[k] for k in range(6)] == ["mpl-2-notice", "mpl-2-notice", "", "bsd-2-text", "", ""]


def test_license_base_phrases(spark):
    """The base phrases are the contract's, whole: a bare mention of the licence's name is no base place."""
    data = ["The MIT license", "used UNDER THE\n(MIT) License. under the mit license", "under the mit licenses", "Apache License, Version 2.0; cc-by-nc"]
    got = license.scan_licenses(odd(spark, list(enumerate(data)))).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got] == [
        (3, 0, None, None, ""), (9, 2, 1, 5, "mit"), (4, 0, None, None, ""), (8, 2, 0, 5, "apache-2,cc-by-nc")]
    assert "mit" not in got[0]["labels"].split(",")


def test_license_labels_on_documents(spark):
    got = {r["doc_id"]: r["labels"] for r in queries.op4_license_scan(spark, SF).collect()}
    base = {"mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for i, t in load(spark):
        if len(t or "") > 3000:
            continue
        words = " " + " ".join(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))) + " "
        want = labels_brute(t or "", license.TEMPLATES) | {label for p, label in base.items() if f" {p} " in words}
        assert got[i] == ",".join(sorted(want))


# ---- op5 ------------------------------------------------------------------
def entropy_brute(text):
    """Every window of every maximal run of one class, counted anew."""
    flagged = set()
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        s, runs = m.group(), []
        if re.search(r"[+/_=-]", s):
            runs.append(("base64", 0, len(s)))
        for r in re.finditer(r"[A-Za-z0-9]+", s):
            if len(r.group()) >= 20 and not re.fullmatch("[0-9A-Fa-f]+", r.group()) or re.fullmatch("[A-Za-z]+", r.group()):
                runs.append(("letters" if r.group().isalpha() else "alnum", *r.span()))
        runs += [("hex", *r.span()) for r in re.finditer("[0-9A-Fa-f]+", s)]
        for name, a, b in runs:
            if any(re.fullmatch(p, s[a:b]) for p in secrets.ALLOWED):
                continue
            for i in range(a, b - 19):
                c = Counter(s[i:i + 20]).values()
                if -sum(n / 20 * log2(n / 20) for n in c) >= secrets.THRESHOLDS[name] - 1e-10:
                    flagged |= set(range(m.start() + i, m.start() + i + 20))
    return flagged


def covered(spans):
    return {p for a, b in spans for p in range(a, b)}


def test_entropy_by_class():
    allowed = [re.compile(p) for p in secrets.ALLOWED]
    found = lambda t: secrets.entropy_spans(t, allowed, secrets.THRESHOLDS)
    for t in ("ghp_16C7e42F292c6912E7710c838347Ae178B4a", "xkQvBnMpLsTwRyHzQwErTyUiOp", "sk-abcdEFGHijklMNOPqrstUVWX", "zX9kQ2vB7nM4pL1sT6wR3yH8"):
        assert found(f"see {t} there"), t
    for t in ("Donaudampfschifffahrtsgesellschaft", "AbstractSingletonProxyFactoryBean", "getElementsByClassNameAndAttributeValue", "a" * 60,
              "snake_case_names_of_some_length_v2", "path/to/some/other/place2/file", "123e4567-e89b-12d3-a456-426614174000",
              "2024-01-01-2024-02-02-2024-03-03", "-" * 50, "0000000000000000000000000000"):
        assert not found(f"see {t} there"), t
    rng = random.Random(5)
    for _ in range(300):
        signs = rng.choice(["0123456789abcdef", "ABCDEFabcdef0123", "abcXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
                            "abcdefghijklmnopqrstuvwxyz0123456789", "ab_-/=", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"])
        parts = ["".join(rng.choice(signs) for _ in range(rng.randrange(5, 60))), "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(0, 40)))]
        t = rng.choice(["", "_", " ", "x"]).join(parts)
        assert covered(found(t)) == entropy_brute(t), t


def test_entropy_spans_on_documents(spark):
    got = {r["doc_id"]: r["spans"] for r in queries.op5_secret_scan(spark, SF).collect()}
    for i, t in load(spark):
        spans = [x.split(":") for x in got[i].split(",") if x]
        base = [(int(s), int(e)) for k, s, e in spans if k != "entropy"]
        mine = covered([(int(s), int(e)) for k, s, e in spans if k == "entropy"])
        left = entropy_brute(t or "")
        assert mine <= left and all(any(s <= p < e for s, e in base) or _near(p, left, base) for p in left - mine), i


def _near(p, flagged, base):
    """Whether the run of flagged places around p meets a base span: such runs are left out."""
    a = b = p
    while a - 1 in flagged:
        a -= 1
    while b + 1 in flagged:
        b += 1
    return any(s <= b and a < e for s, e in base)


# ---- op7 ------------------------------------------------------------------
def test_long_items_in_parts(spark, monkeypatch):
    """Items far beyond a group, cut into overlapping parts: no window is lost, no group holds all."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    items = [(1, " ".join(rng.choice(words) for _ in range(900))), (2, " ".join(rng.choice(words) for _ in range(25))), (3, "one two"), (3, "three")]
    long = items[0][1].split()
    data = [(k, " ".join(["clean"] * 5 + long[k * 7:k * 7 + rng.randrange(8, 30)] + ["end"])) for k in range(100)]
    data += [(200, items[1][1]), (201, "One, TWO!"), (202, None), (None, "x three y"), (203, items[0][1])]
    monkeypatch.setattr(decontaminate, "PART_WORDS", 40)
    monkeypatch.setattr(decontaminate.groups, "__defaults__", (700,))
    bench = spark.createDataFrame(items, "item_id long, text string")
    sizes = [sum(len(t) for _, t in g) for g in decontaminate.groups(bench)]
    assert len(sizes) > 3 and max(sizes) < 0.7 * sum(sizes)
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = leak_brute(data, items)
    assert by_id(decontaminate.report(odd(spark, data), bench).select(*cols)) == want and 50 < sum(r[5] for r in want)
    kept = by_id(decontaminate.clean(odd(spark, data), bench).select("doc_id"))
    assert kept == sorted(((r[0],) for r in want if not r[5]), key=repr)


def test_offsets_in_one_pass():
    text = ("é, Übung — 日本 word; " * 30_000).encode() + b"\xff tail \xe6 end"
    n = len(decontaminate.words_of(text))
    runs = [(k, k + 2) for k in range(0, n - 2, 3)]
    began = time()
    got = decontaminate.to_original(text, runs)
    assert time() - began < 5 and len(got) == len(runs)
    plain = text.decode("utf-8", "surrogateescape")
    at = [m.span() for m in re.finditer("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)]
    assert got == [f"{at[s][0]}:{at[e - 1][1]}" for s, e in runs]


@pytest.mark.parametrize("limit", [2000, 10 ** 6])
def test_spans_do_not_depend_on_the_groups(spark, monkeypatch, limit):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = by_id(decontaminate.report(docs, bench))
    monkeypatch.setattr(decontaminate.groups, "__defaults__", (limit,))
    assert by_id(decontaminate.report(docs, bench)) == want and any(r[-1] for r in want)
