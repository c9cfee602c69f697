"""License scans by template matching.

A license is a template: its wording in marked-up text, where a region between ``<<beginOptional>>`` and
``<<endOptional>>`` may be left out and a ``<<var>>`` may be replaced, by up to a number of free words
(``words=0..12``) or by one of some wordings (``match=a|b``). All templates are compiled into one
automaton over words; a text is accepted where it runs through a template from its first to its last
word. Mandatory wording must match word for word; case, punctuation and line breaks don't matter.
"""

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W


@dataclass(frozen=True)
class Template:
    """``base`` marks the plain phrases whose places are counted."""

    label: str
    text: str
    base: bool = False


# The base phrases and their labels.
BASE_TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

# Public license wordings with their optional and replaceable regions.
_GRANT = "<<var;name=verb;match=licensed|released|distributed|published|available|provided|redistributed>>"
_TERMS = "under <<beginOptional>>the<<endOptional>> <<beginOptional>>terms of the<<endOptional>>"
_OWNER = "<<var;name=owner;words=1..8>>"
_LATER = "<<beginOptional>>or <<beginOptional>>(at your option)<<endOptional>> any later version<<endOptional>>"
_DISCLAIMER = f"""THIS SOFTWARE IS PROVIDED BY {_OWNER} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {_OWNER} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_SOURCE_FORM = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: <<var;name=bullet;words=0..1>> Redistributions of
source code must retain the above copyright notice, this list of conditions and the following disclaimer.
<<var;name=bullet;words=0..1>> Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
TEMPLATES = BASE_TEMPLATES + (
    Template("mit", f"{_GRANT} {_TERMS} <<var;name=name;match=MIT|Expat|X11>> license"),
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the
next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name=owner;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""),
    Template("isc", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies. THE SOFTWARE IS PROVIDED "AS IS" AND {_OWNER} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    Template("bsd-2-clause", f"{_SOURCE_FORM} {_DISCLAIMER}"),
    Template("bsd-3-clause", f"""{_SOURCE_FORM} <<var;name=bullet;words=0..1>> Neither the name of
{_OWNER} nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission. {_DISCLAIMER}"""),
    Template("apache-2", f"{_GRANT} {_TERMS} Apache license <<beginOptional>>version<<endOptional>> 2"
             " <<beginOptional>>0<<endOptional>>"),
    Template("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
<<beginOptional>>http<<beginOptional>>s<<endOptional>><<endOptional>> <<var;name=place;words=0..8>>
<<var;name=unless;match=Unless>> required by applicable law or agreed to in writing, software distributed under
the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied."""),
    Template("gpl-2", f"{_GRANT} {_TERMS} GNU General Public License <<beginOptional>>as published by the Free Software"
             f" Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 2 {_LATER}"),
    Template("gpl-3", f"{_GRANT} {_TERMS} GNU General Public License <<beginOptional>>as published by the Free Software"
             f" Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 3 {_LATER}"),
    Template("lgpl", f"{_GRANT} {_TERMS} GNU Lesser General Public License"),
    Template("agpl-3", f"{_GRANT} {_TERMS} GNU Affero General Public License <<var;name=number;match=version 3|v3|3>>"),
    Template("mpl-2", f"{_GRANT} {_TERMS} Mozilla Public License <<var;name=number;match=version 2|v 2|2>>"),
    Template("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at <<var;name=place;match=http mozilla org mpl 2
0|https mozilla org mpl 2 0>>"""),
    Template("cc-by", "CC BY <<var;name=number;match=2 0|2 5|3 0|4 0>>"),
    Template("cc-by", f"{_GRANT} {_TERMS} Creative Commons Attribution <<var;name=number;match=2 0|2 5|3 0|4 0>>"),
    Template("cc-by-sa", "CC BY SA <<var;name=number;match=2 0|2 5|3 0|4 0>>"),
    Template("cc-by-nc", "Creative Commons Attribution <<var;name=sign;match=Non Commercial|NonCommercial>>"),
    Template("cc0", "<<var;name=name;match=CC0|CC Zero>> 1 0 <<beginOptional>>Universal<<endOptional>>"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^<>]*)>>")
# A-Z lower-cased; all other characters below 128 that are no letter or digit part words
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class _Parts:
    """One template's positions while it is compiled; sets of positions are bits of a number."""

    def __init__(self, automaton):
        self.a = automaton

    def word(self, token: bytes | None, depth: int):
        p = len(self.a.word)
        self.a.word.append(token)
        self.a.depth.append(depth)
        self.a.follow.append(0)
        return 1 << p, 1 << p, False

    def join(self, left, right):
        for p in _bits(left[1]):
            self.a.follow[p] |= right[0]
        return (left[0] | (right[0] if left[2] else 0), right[1] | (left[1] if right[2] else 0), left[2] and right[2])

    def either(self, parts):
        first = last = 0
        for p in parts:
            first, last = first | p[0], last | p[1]
        return first, last, any(p[2] for p in parts)


EMPTY = (0, 0, True)


def _bits(x: int):
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


class Automaton:
    """All templates as one automaton: a state is the set of positions that a text may have reached.
    Steps that were taken are remembered, up to ``memory`` of them."""

    def __init__(self, templates, least: int, memory: int = 1 << 17):
        self.templates, self.memory = tuple(templates), memory
        self.word, self.depth, self.follow = [], [], []
        self.owner, self.total, self.start, self.ends = [], [], 0, 0
        for k, t in enumerate(self.templates):
            first, last, empty, total = self._compile(t.text)
            if empty:
                raise ValueError(f"a template of {t.label} has no mandatory wording")
            self.start |= first
            self.ends |= last
            self.total.append(total)
            self.owner += [k] * (len(self.word) - len(self.owner))
        masks, free = {}, 0
        for p, w in enumerate(self.word):
            if w is None:
                free |= 1 << p
            else:
                masks[w] = masks.get(w, 0) | 1 << p
        self.free, self.masks = free, {w: m | free for w, m in masks.items()}
        self.first = {w for w, m in masks.items() if m & self.start}
        # share of the mandatory words that a position stands behind, of templates that are long enough
        self.share = [d / self.total[o] if self.total[o] >= least else 0.0 for d, o in zip(self.depth, self.owner)]
        self.steps: dict = {}

    def _compile(self, text: str):
        parts, stack, depth = _Parts(self), [EMPTY], 0
        for k, piece in enumerate(_MARKUP.split(text)):
            if k % 2 == 0:
                for w in tokens(piece):
                    depth += len(stack) == 1
                    stack[-1] = parts.join(stack[-1], parts.word(w, depth))
            elif piece == "beginOptional":
                stack.append(EMPTY)
            elif piece == "endOptional":
                if len(stack) == 1:
                    raise ValueError("a region ends that did not begin")
                first, last, _ = stack.pop()
                stack[-1] = parts.join(stack[-1], (first, last, True))
            else:
                stack[-1] = parts.join(stack[-1], self._variable(parts, piece, depth))
        if len(stack) > 1:
            raise ValueError("an optional region does not end")
        return *stack[0], depth

    def _variable(self, parts, piece: str, depth: int):
        given = dict(x.split("=", 1) for x in " ".join(piece.split()).split(";")[1:])
        if "words" in given:
            low, high = map(int, given["words"].split(".."))
            out = EMPTY
            for i in range(high, 0, -1):  # from the end: a word and, optionally, those behind it
                out = parts.join(parts.word(None, depth), out)
                out = (out[0], out[1], i > low)
            return out
        found = []
        for wording in given["match"].split("|"):
            one = EMPTY
            for w in tokens(wording):
                one = parts.join(one, parts.word(w, depth))
            found.append(one)
        return parts.either(found)

    def step(self, state: int, token: bytes) -> tuple[int, list[int], float]:
        """(state, templates that end here, largest share) behind one more word; state 0 starts."""
        key = (state, token if token in self.masks else None)
        if key not in self.steps:
            reach = self.start if not state else 0
            for p in _bits(state):
                reach |= self.follow[p]
            new = reach & self.masks.get(token, self.free)
            if len(self.steps) >= self.memory:
                self.steps.clear()
            self.steps[key] = (new, sorted({self.owner[p] for p in _bits(new & self.ends)}),
                               max((self.share[p] for p in _bits(new)), default=0.0))
        return self.steps[key]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], float]:
        """(start, stop, template) of all matches, each the longest from its start and not inside one of
        the same template that ends at the same word; and the score."""
        score, longest = 0.0, {}
        first, step = self.first, self.step
        for i in [i for i, w in enumerate(words) if w in first]:
            state, at = 0, i
            while at < len(words):
                state, done, share = step(state, words[at])
                if not state:
                    break
                at += 1
                score = max(score, share)
                for k in done:
                    longest[k, i] = at
        seen, out = set(), []
        for (k, i), stop in sorted(longest.items()):
            if (k, stop) not in seen:
                seen.add((k, stop))
                out.append((i, stop, k))
        return sorted(out), 1.0 if out else score


MATCH = "struct<start:bigint,stop:bigint,label:string,template:int,base:boolean>"
ARROW = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("template", pa.int32()),
                   ("base", pa.bool_())])


def scan_licenses(docs: DataFrame, templates=TEMPLATES, text: str = "text", doc_id: str = "doc_id",
                  least: int = 8) -> DataFrame:
    """(doc_id, n_words, matches, score) for every row of ``docs``. ``matches`` are (start, stop, label,
    template, base) by start: the places, in words from 0, where the text runs through a template.
    ``score`` is 1 with a match, else the largest share of a template's mandatory words that the text
    follows without a break from the template's start, over templates of ``least`` mandatory words.

    Words are what characters below 128 that are neither letters nor digits part, A-Z lower-cased.
    A template must hold mandatory wording, and not begin with free words. Null and empty texts have no words and no
    matches. Rows are independent: repeated rows repeat, other columns of ``docs`` are not read, an empty
    table gives an empty result. Texts of any length are used whole; nothing is shuffled.
    """
    templates = tuple(templates)
    compiled = Automaton(templates, least)  # a bad template fails here, not in a task
    if any(compiled.word[p] is None for p in _bits(compiled.start)):
        raise ValueError("a template begins with free words")

    def step(batches):
        automaton = Automaton(templates, least)
        for batch in W.slices(batches, "_t"):
            out = []
            for t in batch.column(1).to_pylist():
                words = tokens(t)
                found, score = automaton.scan(words)
                out.append((len(words), [{
                    "start": a, "stop": b, "label": templates[k].label, "template": k, "base": templates[k].base}
                    for a, b, k in found], score))
            yield pa.record_batch(
                [batch.column(0), *[pa.array([x[c] for x in out], kind) for c, kind in enumerate(
                    (pa.int64(), pa.list_(ARROW), pa.float64()))]],
                names=["doc_id", "n_words", "matches", "score"])

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    return rows.mapInArrow(step, f"doc_id {kind}, n_words long, matches array<{MATCH}>, score double")


def labels(matches: Column) -> Column:
    """The distinct labels, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
