"""SentencePiece encoding and decoding with a shared-prefix Viterbi.

A text, with one blank put before it, is cut into units: a run of blanks and the word after it, each blank written as U+2581. The
distinct units of a slice of documents are sorted, which lays them out as
the depth-first order of their trie, and segmented one after the other: the
forward scores of the prefix shared with the unit before are reused. A unit's
best segmentation maximises the summed piece scores; the pieces' order in the
vocabulary stands for their frequency (score = -log(rank + 2)). Pieces are runs of blanks, or begin with
one blank or none; as no piece goes on after a word's last letter, the best units make the best text. Characters
without a piece become byte pieces, so decoding restores every text exactly.

One pass without a shuffle; a task holds a slice of texts and segmented units of at most about
``CACHE_BYTES``. Units over ``LONG_UNIT`` characters (a text without blanks is one) are never remembered, and
their search gives out what all its open paths agree on every ``LONG_UNIT`` characters, so that it holds no more than
that and a few times the longest piece. The vocabulary (bounded by its file) is read by
the driver from a path that is a parameter, and shipped.

Defined cases: null and empty texts have no ids and decode to the empty text; a
literal U+2581 is spelt in byte pieces; blanks of any number and all other white
space are kept; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import re
from hashlib import sha256
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, scan, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LITERAL = "\ud800"              # stands for a U+2581 of the text itself; no text can hold it
CACHE_BYTES = 64 << 20
UNIT_BYTES, CHARACTER_BYTES, ID_BYTES = 200, 4, 8       # about what a remembered unit takes, each of its characters and its ids
LONG_UNIT = 1 << 16
BYTE_PENALTY = 10.0             # a byte piece costs this much more than the rarest piece


_UNIT, _MARKS = re.compile(f"{MARK}+[^{MARK}]*"), re.compile(f"{MARK}*")


class Vocabulary:
    """Pieces by place: ``head`` starts a marked word, ``body`` continues it, ``runs`` are blanks only (by their number)."""

    def __init__(self, pieces: list[tuple[str, int]], byte_ids: list[int]):
        self.byte_ids = byte_ids
        self.head: dict[str, tuple[float, int]] = {}
        self.body: dict[str, tuple[float, int]] = {}
        self.runs: dict[int, tuple[float, int]] = {}
        self.spelling: dict[int, bytes] = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        for rank, (piece, i) in enumerate(pieces):
            if MARK not in piece:
                self.body[piece] = (-log(rank + 2), i)
            elif piece.rfind(MARK) == 0:
                self.head[piece] = (-log(rank + 2), i)
            elif piece.count(MARK) < len(piece):
                raise ValueError(f"the piece {piece!r} goes on after a word's end")
            if piece.count(MARK) == len(piece):
                self.runs[len(piece)] = (-log(rank + 2), i)
            self.spelling[i] = piece.replace(MARK, " ").encode()
        self.byte_score = -log(len(pieces) + 2) - BYTE_PENALTY
        self.ends: dict = {}            # trie of the body pieces read backwards; at key 0 the piece's (score, ids)
        for piece, (score, i) in self.body.items():
            node = self.ends
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[0] = (score, (i,))
        self.longest = max(map(len, chain(self.head, self.body)), default=1)
        self.reach = max(self.longest, *self.runs, 1)       # no piece is longer


def load(model: str = MODEL) -> Vocabulary:
    """Normal pieces by descending score, and the ids of the 256 byte pieces."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    normal = [i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    normal.sort(key=lambda i: (-sp.get_score(i), i))
    return Vocabulary([(sp.id_to_piece(i), i) for i in normal],
                      [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def advance(unit: str, marks: int, lo: int, v: Vocabulary, best: list[float], back: list) -> None:
    """Viterbi for the prefixes of ``lo`` and more characters; the unit begins with ``marks`` blanks. best[j]: score of
    the best path to character j, back[j]: where its last piece begins and that piece's ids."""
    head, body, ends, longest = v.head, v.body, v.ends, v.longest
    word = marks - 1                                  # the last blank belongs to the word's first piece, or not
    last_head = word + longest if marks else 0
    for j in range(lo, min(len(unit), marks) + 1):    # inside the run of blanks
        top, came = -1e300, None
        for n, (score, i) in v.runs.items():
            if n <= j and best[j - n] + score > top:
                top, came = best[j - n] + score, (j - n, (i,))
        if 1 not in v.runs and best[j - 1] + v.byte_score > top:
            top, came = best[j - 1] + v.byte_score, (j - 1, (v.byte_ids[32],))
        best.append(top)
        back.append(came)
    for j in range(max(lo, marks + 1), len(unit) + 1):
        top, came = -1e300, None
        node, i = ends, j
        while i > marks:                              # pieces that end here, from the shortest on
            i -= 1
            node = node.get(unit[i])
            if node is None:
                break
            hit = node.get(0)
            if hit is not None and best[i] + hit[0] > top:
                top, came = best[i] + hit[0], (i, hit[1])
        if j <= last_head:                            # a piece that starts the word
            hit = head.get(unit[word:j])
            if hit is not None and best[word] + hit[0] > top:
                top, came = best[word] + hit[0], (word, (hit[1],))
        c = unit[j - 1]
        if c not in body:                             # no piece of its own: spelt in bytes
            raw = MARK.encode() if c == LITERAL else c.encode("utf-8", "surrogateescape")
            if best[j - 1] + v.byte_score * len(raw) > top:
                top, came = best[j - 1] + v.byte_score * len(raw), (j - 1, tuple(v.byte_ids[b] for b in raw))
        best.append(top)
        back.append(came)


def walk(back: list, end: int) -> list[int]:
    """The ids of the path to character ``end``, in order."""
    path = []
    while end:
        end, ids = back[end]
        path.append(ids)
    return list(chain.from_iterable(reversed(path)))


def segment(units: list[str], v: Vocabulary) -> dict[str, tuple[int, ...]]:
    """Best segmentation of every unit, in sorted order with shared forward scores."""
    out: dict[str, tuple[int, ...]] = {}
    best: list[float] = [0.0]
    back: list = [(0, ())]
    before = ""
    for unit in sorted(units):
        shared = 0
        for a, b in zip(before, unit):
            if a != b:
                break
            shared += 1
        del best[shared + 1:], back[shared + 1:]
        advance(unit, _MARKS.match(unit).end(), shared + 1, v, best, back)
        out[unit] = tuple(walk(back, len(unit)))
        before = unit
    return out


def segment_long(unit: str, v: Vocabulary) -> list[int]:
    """The same for one unit of any length, in bounded memory: later pieces reach back ``reach`` characters at most, so
    what all paths from these share is settled."""
    out: list[int] = []
    best, back, gone, marks = [0.0], [(0, ())], 0, _MARKS.match(unit).end()
    while True:
        part = unit[gone:gone + len(best) - 1 + LONG_UNIT]
        advance(part, max(0, marks - gone), len(best), v, best, back)
        if gone + len(part) == len(unit):
            return out + walk(back, len(part))
        open_ends = set(range(max(0, len(part) - v.reach), len(part) + 1))
        while len(open_ends) > 1:
            last = max(open_ends)
            open_ends.remove(last)
            open_ends.add(back[last][0])
        settled = open_ends.pop()
        out += walk(back, settled)
        best = best[settled:]
        back = [(max(0, i - settled), ids) for i, ids in back[settled:]]
        gone += settled


def words_of(text: bytes) -> list[str]:
    """The units of a text."""
    if not text:
        return []
    plain = text.decode("utf-8", "surrogateescape").replace(MARK, LITERAL)
    if "  " in plain or plain[0] == " ":
        return _UNIT.findall(MARK + plain.replace(" ", MARK))
    return [MARK + w for w in plain.split(" ")]


class Encoder:
    """Segments slices of texts; remembers units of a bounded size."""

    def __init__(self, v: Vocabulary):
        self.v, self.known, self.size = v, {}, 0

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        cut = [words_of(t) for t in texts]
        units = set(chain.from_iterable(cut))
        long = {u: segment_long(u, self.v) for u in units if len(u) > LONG_UNIT}
        found = segment(list(units.difference(self.known, long)), self.v)
        size = sum(UNIT_BYTES + CHARACTER_BYTES * len(u) + ID_BYTES * len(ids) for u, ids in found.items())
        if self.size + size <= CACHE_BYTES:
            self.known |= found
            self.size += size
            found = self.known
        else:                                   # begin anew, with the units of this slice if they are not too many
            met = {u: self.known[u] for u in units.intersection(self.known)}
            self.known, self.size = (found, size) if size <= CACHE_BYTES else ({}, 0)
            found = found | met
        if long:
            found = found | long
        return [list(chain.from_iterable(map(found.__getitem__, words))) for words in cut]


def decode_ids(ids, v: Vocabulary) -> bytes:
    """The text; the first piece's mark stands for no blank."""
    return b"".join(map(v.spelling.__getitem__, ids))[1:]


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_ids, decoded_sha256 (of the text decoded from ids), round_trip."""
    shipped = ship(docs, load(model))

    def make():
        encoder = Encoder(shipped.value)

        def work(columns, texts):
            ids = encoder.encode(texts)
            plain = [decode_ids(x, encoder.v) for x in ids]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            return {"doc_id": columns[0], "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    "n_ids": np.diff(ends).tolist(), "round_trip": [p == t for p, t in zip(plain, texts)],
                    "decoded_sha256": [sha256(p).hexdigest() for p in plain]}
        return work

    return scan(id_and_text(docs), make, "doc_id long, ids array<int>, n_ids long, decoded_sha256 string, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text from the ids that :func:`encode` returns (null ids: empty text)."""
    shipped = ship(encoded, load(model))

    def run(batches):
        for batch in batches:
            texts = [decode_ids(x or (), shipped.value) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).view(pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
