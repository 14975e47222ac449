"""Secret scan: known forms of keys, and windows of high entropy in candidate strings.

Base forms are regular expressions (leftmost, not overlapping, by kind). The
entropy method cuts every candidate string into maximal runs of one character class - hexadecimal digits,
letters, letters and digits, all of base 64 - slides a window over each, keeps the counts of
its characters incrementally, and flags windows whose Shannon entropy reaches the
threshold of that class. So a prefix, or what a key is joined to, does not change how the key itself is
judged. Runs on the allow-list add nothing, nor do spans that overlap a base span. One pass over whole texts, no shuffle.

Defined cases: null and empty texts have no spans; repeated rows give equal rows;
other columns are ignored; spans count code points, the end is exclusive.
"""

from __future__ import annotations

import re
from hashlib import sha256
from math import log2

from pyspark.sql import DataFrame

from .common import id_and_text, scan

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: bits per character of a window, by the class of its run. Few signs can say less; letters
#: alone also spell words and names, whose windows stay below 4
THRESHOLDS = {"hex": 3.0, "letters": 4.0, "alnum": 3.75, "base64": 3.75}
ALLOWED = (r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",        # a UUID
           r"[0-9]{4}-[0-9]{2}-[0-9]{2}T?[0-9-]*",                                  # a date
           r"[A-Za-z]*[_/+=-]+", r"[0-9_/+=-]+",                                    # a word and marks, digits and marks
           r"(?:[A-Za-z]+[0-9]{0,4}[/_+=-]+)+[A-Za-z]*[0-9]{0,4}")                  # words joined by marks

# fixed values: the base forms
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
_MARKS = re.compile(r"[+/_=-]")
_ALNUM, _HEX_RUN = re.compile(rf"[A-Za-z0-9]{{{WINDOW},}}"), re.compile(rf"[0-9A-Fa-f]{{{WINDOW},}}")
_LETTERS = re.compile(r"[A-Za-z]+")
_C_LOG_C = [0.0] + [c * log2(c) for c in range(1, WINDOW + 2)]


def windows_above(s: str, least: float) -> list[tuple[int, int]]:
    """Maximal unions of windows of ``s`` with an entropy of ``least`` or more."""
    spans = []
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1                     # total: sum of c * log2(c) over the window
    most = WINDOW * (log2(WINDOW) - least) + 1e-9
    for i, c in enumerate(s):
        k = counts.get(c, 0)
        counts[c] = k + 1
        total += _C_LOG_C[k + 1] - _C_LOG_C[k]
        if i >= WINDOW:
            old = s[i - WINDOW]
            k = counts[old]
            counts[old] = k - 1
            total += _C_LOG_C[k - 1] - _C_LOG_C[k]
        if i >= WINDOW - 1 and total <= most:
            if i - WINDOW + 1 > end:
                if start >= 0:
                    spans.append((start, end))
                start = i - WINDOW + 1
            end = i + 1
    if start >= 0:
        spans.append((start, end))
    return spans


def class_runs(candidate: str) -> list[tuple[str, int, int]]:
    """(class, start, end) of the maximal runs of every class in a candidate; a run of hexadecimal digits within a
    longer run is judged for itself, runs of a wider class that add no sign to a smaller one are not."""
    runs = [("base64", 0, len(candidate))] if _MARKS.search(candidate) else []
    for m in _ALNUM.finditer(candidate):
        if _LETTERS.fullmatch(m.group()):
            runs.append(("letters", *m.span()))
        elif not _HEX_RUN.fullmatch(m.group()):
            runs.append(("alnum", *m.span()))
    return runs + [("hex", *m.span()) for m in _HEX_RUN.finditer(candidate)]


def entropy_spans(text: str, allowed: list, thresholds: dict[str, float]) -> list[tuple[int, int]]:
    """Unions of the windows above their class's threshold, in order."""
    found = []
    for m in _CANDIDATE.finditer(text):
        s = m.group()
        for name, start, end in class_runs(s):
            run = s[start:end]
            if not any(p.fullmatch(run) for p in allowed):
                found += [(m.start() + start + a, m.start() + start + b) for a, b in windows_above(run, thresholds[name])]
    spans: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def find_secrets(raw: bytes, allowed: list, thresholds: dict[str, float]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; kind indexes KINDS."""
    text = raw.decode("utf-8", "surrogateescape")
    found = []
    low = raw.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if _CANDIDATE.search(text):                          # every access or hex key lies in such a string
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
        base = list(found)
        found += [(s, 3, e) for s, e in entropy_spans(text, allowed, thresholds)
                  if not any(b[0] < e and s < b[2] for b in base)]
    return sorted(found)


def scan_secrets(docs: DataFrame, allow_list: tuple[str, ...] = ALLOWED,
                 thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    def make():
        allowed = [re.compile(p) for p in allow_list]

        def one(doc_id, raw):
            found = find_secrets(raw, allowed, thresholds)
            base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found if k < 3)
            count = [sum(f[1] == k for f in found) for k in range(4)]
            return (doc_id, *count, sha256(base.encode()).hexdigest(),
                    ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found))

        names = ("doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans")

        def work(columns, texts):
            return dict(zip(names, map(list, zip(*(one(i, t) for i, t in zip(columns[0], texts))))))
        return work

    return scan(id_and_text(docs), make, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, "
                                         "base_sha256 string, spans string")
