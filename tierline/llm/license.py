"""License scan: template markup compiled to token automata.

Markup: plain words are mandatory, ``[[ ... ]]`` is optional (may nest),
``<<0-6>>`` is replaceable by that many words of any kind. A template compiles
to a small nondeterministic automaton over words (:func:`compile_template`); a place
in a text is accepted when the automaton reaches its end there, so the mandatory
wording matches exactly. Licences are whole texts: a grant whose later conditions were changed gets no label.
A label may have several templates. One pass over whole texts, no shuffle.

Defined cases: null and empty texts have no words, no labels, score 0; repeated
rows give equal rows; other columns are ignored. ``score`` is the share of a
text's words that lie inside accepted places.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from .common import id_and_text, scan

# fixed values: the base phrases and their labels
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_SUBJECT = "without warranty of any kind express or implied including but not limited to the warranties of merchantability"
_BSD_END = ("this software is provided by <<1-12>> as is and any express or implied warranties including but not limited to the "
            "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<1-12>> be liable "
            "for any direct indirect incidental special exemplary or consequential damages including but not limited to "
            "procurement of substitute goods or services loss of use data or profits or business interruption however caused "
            "and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
            "arising in any way out of the use of this software even if advised of the possibility of such damage")
_BSD_BEGIN = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
              "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list "
              "of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright "
              "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
              "with the distribution")

# whole licence texts, and notices that are complete in themselves, in markup, by the label they prove
TEMPLATES: dict[str, str | tuple[str, ...]] = {
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files the software to deal in the software without restriction including without limitation the "
                "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
                "notice and this permission notice [[including the next paragraph]] shall be included in all copies or "
                f"substantial portions of the software the software is provided as is {_SUBJECT} fitness for a particular purpose "
                "and noninfringement in no event shall <<1-8>> be liable for any claim damages or other liability whether in an "
                "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
                "dealings in the software [[except as contained in this notice <<1-60>>]]",
    "bsd-2-text": f"{_BSD_BEGIN} {_BSD_END}",
    "bsd-3-text": f"{_BSD_BEGIN} [[3]] neither the name of <<1-12>> nor the names of [[its]] [[any]] [[other]] contributors may be used to "
                  f"endorse or promote products derived from this software without specific prior written permission {_BSD_END}",
    "isc-text": "permission to use copy modify [[and]] [[or]] distribute this software for any purpose with or without fee is hereby "
                "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
                "provided as is and <<1-8>> [[disclaim]] [[disclaims]] all warranties with regard to this software including all implied "
                "warranties of merchantability and fitness in no event shall <<1-8>> be liable for any special direct indirect or "
                "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
                "of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
                 "for any damages arising from the use of this software permission is granted to anyone to use this software for any "
                 "purpose including commercial applications and to alter it and redistribute it freely subject to the following "
                 "restrictions [[1]] the origin of this software must not be misrepresented you must not claim that you wrote the "
                 "original software if you use this software in a product an acknowledgment in the product documentation would be "
                 "appreciated but is not required [[2]] altered source versions must be plainly marked as such and must not be "
                 "misrepresented as being the original software [[3]] this notice may not be removed or altered from any source distribution",
    "apache-2-text": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
                     "license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses license 2 0 unless "
                     "required by applicable law or agreed to in writing software distributed under the license is distributed on an "
                     "as is basis without warranties or conditions of any kind either express or implied see the license for the "
                     "specific language governing permissions and limitations under the license",
    "mit-notice": "[[released]] [[licensed]] under the [[terms of the]] mit license",
    "apache-2-notice": "licensed under the apache license version 2 [[0]] [[the license]]",
    "gpl-notice": "under the terms of the gnu [[lesser]] [[affero]] general public license as published by the "
                  "free software foundation",
    "gpl-version": "gnu [[lesser]] [[affero]] general public license [[as published by <<0-6>>]] version <<1-1>>",
    "mpl-2-notice": ("subject to the terms of the mozilla public license v 2 0", "subject to the terms of the mozilla public license version 2 0"),
    "cc-by-nc-notice": "licensed under [[a]] [[the]] [[creative commons]] cc by nc [[sa]] [[nd]] <<0-2>> [[international]] [[license]]",
    "cc-by-notice": "licensed under [[a]] [[the]] creative commons attribution <<0-4>> license",
    "proprietary": "copyright [[c]] <<1-6>> all rights reserved",
}

_FOLD = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.array([bool(_WORD.match(bytes([i]))) for i in range(256)])
_MARK = re.compile(r"\[\[|\]\]|<<(\d+)-(\d+)>>|[^\s\[\]<>]+")


class Automaton:
    """``moves[state][word]`` and ``any[state]`` lead on; ``skip[state]`` costs no word."""

    def __init__(self):
        self.moves: list[dict] = [{}]
        self.any: list[list] = [[]]
        self.skip: list[list] = [[]]
        self.mandatory: list[bytes] = []
        self.end = 0

    def state(self) -> int:
        for x, new in ((self.moves, {}), (self.any, []), (self.skip, [])):
            x.append(new)
        return len(self.moves) - 1

    def closure(self, states) -> set:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def first_words(self) -> set:
        return {w for s in self.closure([0]) for w in self.moves[s]}

    def longest(self, words: list, start: int) -> int:
        """End (exclusive) of the longest accepted place at ``start``; -1 if none."""
        states, best = self.closure([0]), -1
        for i in range(start, len(words) + 1):
            if self.end in states:
                best = i
            if i == len(words) or not states:
                break
            word = words[i]
            states = self.closure({t for s in states for t in (*self.moves[s].get(word, ()), *self.any[s])})
        return best


def compile_template(markup: str) -> Automaton:
    a, here, opened = Automaton(), 0, []
    for m in _MARK.finditer(markup):
        token = m.group()
        if token == "[[":
            opened.append(here)
        elif token == "]]":
            after = a.state()
            a.skip[here].append(after)
            a.skip[opened.pop()].append(after)
            here = after
        elif m.group(1):
            low, high = int(m.group(1)), int(m.group(2))
            leave = []
            for k in range(high):
                if k >= low:
                    leave.append(here)
                after = a.state()
                a.any[here].append(after)
                here = after
            after = a.state()
            for s in (*leave, here):
                a.skip[s].append(after)
            here = after
        else:
            after = a.state()
            a.moves[here].setdefault(token.encode(), []).append(after)
            if not opened:
                a.mandatory.append(token.encode())
            here = after
    if opened:
        raise ValueError(f"an optional region is not closed: {markup}")
    a.end = here
    return a


def compiled(templates: dict[str, str | tuple[str, ...]]) -> list[tuple[str, Automaton, bytes]]:
    """(label, automaton, its longest mandatory word) of every template: a text without that word cannot match."""
    made = [(label, compile_template(text)) for label, texts in templates.items()
            for text in ((texts,) if isinstance(texts, str) else texts)]
    return [(label, a, max(a.mandatory, key=len)) for label, a in made]


def places(words: list, automata: list) -> list[tuple[str, int, int]]:
    """(label, start, end) of every accepted place: all starts, longest end of each."""
    first: dict[bytes, list] = {}
    for label, a, _ in automata:
        for w in a.first_words():
            first.setdefault(w, []).append((label, a))
    return [(label, i, end) for i, w in enumerate(words) if w in first
            for label, a in first[w] if (end := a.longest(words, i)) >= 0]


def count_words(text: bytes) -> int:
    inside = _IS_WORD[np.frombuffer(text, np.uint8)]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


def scan_licenses(docs: DataFrame, templates: dict[str, str | tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """One row per document; ``places`` lists the accepted places as label:start:end."""

    def make():
        base = [(BASE[text], compile_template(text), max(text.encode().split(), key=len)) for text in BASE]
        more = compiled(templates)

        def one(doc_id, raw):
            text = raw.translate(_FOLD)
            b = [x for x in base if x[2] in text]
            t = [x for x in more if x[2] in text]
            if not b and not t:
                return doc_id, count_words(text), 0, None, None, "", "", 0.0, []
            words = _WORD.findall(text)
            found, extra = places(words, b), places(words, t)
            starts = [p[1] for p in found]
            covered = np.zeros(len(words) + 1, np.int64)
            for _, s, e in found + extra:
                covered[s] += 1
                covered[e] -= 1
            share = float((np.cumsum(covered[:-1]) > 0).mean()) if words else 0.0
            label = lambda rows: ",".join(sorted({p[0] for p in rows}))
            return (doc_id, len(words), len(found), min(starts, default=None), max(starts, default=None),
                    label(found), label(found + extra), share, [f"{n}:{s}:{e}" for n, s, e in found + extra])

        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")

        def work(columns, texts):
            rows = [one(i, t) for i, t in zip(columns[0], texts)]
            return dict(zip(names, map(list, zip(*rows))))
        return work

    return scan(id_and_text(docs), make,
                "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                "base_labels string, labels string, score double, places array<string>")
