"""License scan by template markup.

A template is license wording with regions: `<<beginOptional>>...<<endOptional>>`
may be left out, `<<var;name="...";original="...";match="...">>` may be replaced.
match is `.+`, `.*` or `.{a,b}`, so many words of any kind, or alternative
wordings divided by `|`.  Templates are compiled to one automaton over words:
mandatory words are single steps, optional regions can be passed by, replaceable
ones take what their match allows.  A text is accepted for a template at a place
when the automaton, started there, takes all of its mandatory wording in order.

The automaton is made deterministic as texts are read, one step table per set
of states, and is started only at words that open a template, so most words of
a text cost one look-up.  Regions at the ends of a template decide nothing and
are cut off.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MOST_WORDS = 30       # words that `.+` or `.*` can stand for
MOST_STEPS = 20_000   # step tables kept; beyond, they are made anew
HALF = 4              # mandatory words that give a score of one half
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on lower-cased UTF-8: every byte of a character beyond ASCII is part of a word

# Phrases and labels of the contract.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Public license notices and texts, in template markup.
TEMPLATES = (
    ("gpl-3", 'licensed under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License<<beginOptional>>, as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 3'),
    ("gpl-3", 'under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version'),
    ("gpl-3", 'SPDX-License-Identifier: GPL-3.0'),
    ("gpl-2", 'licensed under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License<<beginOptional>>, as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 2'),
    ("gpl-2", 'under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version'),
    ("gpl-2", 'SPDX-License-Identifier: GPL-2.0'),
    ("lgpl-3", 'under the <<beginOptional>>terms of the<<endOptional>> GNU Lesser General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 3'),
    ("lgpl-2.1", 'under the <<beginOptional>>terms of the<<endOptional>> GNU Lesser General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>; either<<endOptional>> version 2.1'),
    ("agpl-3", 'under the <<beginOptional>>terms of the<<endOptional>> GNU Affero General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 3'),
    ("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at <<var;name="address";original="http://www.apache.org/licenses/LICENSE-2.0";match=".{1,12}">> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("apache-2", 'SPDX-License-Identifier: Apache-2.0'),
    ("mit", '<<var;name="copyright";original="Copyright (c) year holder";match=".*">> Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="software";original="this software and associated documentation files (the "Software")";match=".{1,12}">>, to deal in <<var;name="short";original="the Software";match="the software|this software|the materials">> without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="holder";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".+">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE'),
    ("mit", 'SPDX-License-Identifier: MIT'),
    ("isc", 'Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";original="THE AUTHOR";match=".+">> <<var;name="verb";original="DISCLAIMS";match="disclaim|disclaims">> ALL WARRANTIES WITH REGARD TO THIS SOFTWARE'),
    ("isc", 'SPDX-License-Identifier: ISC'),
    ("bsd-2-clause", 'Redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<var;name="bullet";original="1.";match=".{0,1}">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<var;name="bullet";original="2.";match=".{0,1}">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY <<var;name="holder";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".+">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'),
    ("bsd-3-clause", 'Redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<var;name="bullet";original="1.";match=".{0,1}">> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<var;name="bullet";original="2.";match=".{0,1}">> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. <<var;name="bullet";original="3.";match=".{0,1}">> Neither the name of <<var;name="organisation";original="the copyright holder";match=".+">> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission'),
    ("bsd-2-clause", 'SPDX-License-Identifier: BSD-2-Clause'),
    ("bsd-3-clause", 'SPDX-License-Identifier: BSD-3-Clause'),
    ("mpl-2", 'subject to the terms of the Mozilla Public License, <<var;name="version";original="v.";match="v|version">> 2.0'),
    ("mpl-2", 'SPDX-License-Identifier: MPL-2.0'),
    ("cc-by-nc", 'licensed under <<beginOptional>>a<<endOptional>><<beginOptional>>the<<endOptional>> Creative Commons Attribution-NonCommercial <<var;name="version";original="4";match="2|3|4">>.0'),
    ("cc-by-nc-sa", 'licensed under <<beginOptional>>a<<endOptional>><<beginOptional>>the<<endOptional>> Creative Commons Attribution-NonCommercial-ShareAlike <<var;name="version";original="4";match="2|3|4">>.0'),
    ("cc-by-sa", 'licensed under <<beginOptional>>a<<endOptional>><<beginOptional>>the<<endOptional>> Creative Commons Attribution-ShareAlike <<var;name="version";original="4";match="2|3|4">>.0'),
    ("cc-by-sa", 'licensed under CC BY-SA'),
    ("cc0", 'SPDX-License-Identifier: CC0-1.0'),
    ("unlicense", 'This is free and unencumbered software released into the public domain'),
    ("zlib", 'This software is provided \'as-is\', without any express or implied warranty. In no event will the <<var;name="authors";original="authors";match=".{1,10}">> be held liable for any damages arising from the use of this software'),
)


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; only A-Z is lower-cased."""
    return WORD.findall(text.lower())


@dataclass(frozen=True)
class Free:
    """From least to most words of any kind."""

    least: int
    most: int


@dataclass(frozen=True)
class Choice:
    """One of several sequences; an optional region is a sequence or nothing."""

    ways: tuple[tuple, ...]


_MARK = re.compile(r'<<(beginOptional|endOptional|var;(?:[^">]|"(?:[^"]|"(?!;|>>))*")*)>>', re.S)
_MATCH = re.compile(r'match="((?:[^"]|"(?!;|$))*)"')


def _variable(mark: str) -> Free | Choice:
    found = _MATCH.search(mark)
    how = found.group(1) if found else ".+"
    if how in (".+", ".*"):
        return Free(how == ".+", MOST_WORDS)
    bounds = re.fullmatch(r"\.\{(\d+),(\d+)\}", how)
    if bounds:
        return Free(int(bounds.group(1)), int(bounds.group(2)))
    return Choice(tuple(tuple(words(way.encode())) for way in how.split("|")))


def parse(markup: str) -> tuple:
    """Words (bytes), Free and Choice items of a template, without regions at its ends."""
    levels: list[list] = [[]]
    at = 0
    for m in _MARK.finditer(markup):
        levels[-1] += words(markup[at:m.start()].encode())
        at = m.end()
        if m.group(1) == "beginOptional":
            levels.append([])
        elif m.group(1) == "endOptional":
            if len(levels) < 2:
                raise ValueError("an optional region ends that did not begin")
            inside = tuple(levels.pop())
            levels[-1].append(Choice((inside, ())))
        else:
            levels[-1].append(_variable(m.group(1)))
    levels[-1] += words(markup[at:].encode())
    if len(levels) > 1:
        raise ValueError("an optional region does not end")
    items = levels[0]
    while items and not isinstance(items[0], bytes):
        items.pop(0)
    while items and not isinstance(items[-1], bytes):
        items.pop()
    if not items:
        raise ValueError("a template needs mandatory wording")
    return tuple(items)


def mandatory(items: Sequence) -> int:
    """Words that every text of the template must have and that are not free."""
    return sum(1 if isinstance(x, bytes) else min(map(mandatory, x.ways)) if isinstance(x, Choice) else 0 for x in items)


@dataclass
class Automaton:
    """All templates as one word automaton; states are numbers, `step` and `skip` its word and empty moves."""

    labels: list[str]
    sizes: list[int]
    base: int  # the first `base` templates are the base phrases
    step: list[list[tuple[bytes | None, int]]] = field(default_factory=list)  # None: any word
    skip: list[list[int]] = field(default_factory=list)
    final: dict[int, int] = field(default_factory=dict)
    begin: list[int] = field(default_factory=list)

    @classmethod
    def build(cls, base: Sequence[tuple[str, str]] = BASE, templates: Sequence[tuple[str, str]] = TEMPLATES) -> "Automaton":
        parsed = [(label, parse(markup)) for label, markup in (*base, *templates)]
        out = cls([label for label, _ in parsed], [mandatory(items) for _, items in parsed], len(base))
        for number, (_, items) in enumerate(parsed):
            first = out._state()
            out.begin.append(first)
            out.final[out._sequence(items, first)] = number
        return out

    def _state(self) -> int:
        self.step.append([])
        self.skip.append([])
        return len(self.step) - 1

    def _move(self, state: int, word: bytes | None) -> int:
        self.step[state].append((word, len(self.step)))
        return self._state()

    def _sequence(self, items: Sequence, state: int) -> int:
        for x in items:
            if isinstance(x, bytes):
                state = self._move(state, x)
            elif isinstance(x, Free):
                ends = []
                for i in range(x.most):
                    if i >= x.least:
                        ends.append(state)
                    state = self._move(state, None)
                for e in ends:
                    self.skip[e].append(state)
            else:
                ends = [self._sequence(way, state) for way in x.ways]
                state = self._state()
                for e in ends:
                    self.skip[e].append(state)
        return state

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _made(self) -> None:
        """Tables of the deterministic form; state 0 is dead, 1 the start."""
        self._known = {w for moves in self.step for w, _ in moves if w is not None}
        self._sets, self._numbers, self._next, self._accept = [], {}, [], []
        for states in (frozenset(), self._closed(set(self.begin))):
            self._number(states)
        self._openers = {w for s in self._sets[1] for w, _ in self.step[s] if w is not None}

    def _number(self, states: frozenset[int]) -> int:
        found = self._numbers.get(states)
        if found is None:
            found = self._numbers[states] = len(self._sets)
            self._sets.append(states)
            self._next.append({})
            self._accept.append(tuple(sorted(self.final[s] for s in states if s in self.final)))
        return found

    def places(self, text: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, template, end) of every accepted place, with the farthest end; words are numbered from 0, end is exclusive."""
        if not hasattr(self, "_next") or len(self._sets) > MOST_STEPS:
            self._made()
        found = []
        n, openers, known = len(text), self._openers, self._known
        for start in [i for i, w in enumerate(text) if w in openers]:
            state, at, ends = 1, start, {}
            while at < n:
                word = text[at]
                word = word if word in known else None
                to = self._next[state].get(word)
                if to is None:
                    moved = {t for s in self._sets[state] for w, t in self.step[s] if w is None or w == word}
                    to = self._next[state][word] = self._number(self._closed(moved))
                if not to:
                    break
                state, at = to, at + 1
                for t in self._accept[state]:
                    ends[t] = at
            found += [(start, t, end) for t, end in sorted(ends.items())]
        return found


def score(sizes: Sequence[int]) -> float:
    """Half at HALF mandatory words of the largest accepted template, towards 1 with more; 0 without one."""
    m = max(sizes, default=0)
    return m / (m + HALF)


def _utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary").alias("text")


def scan(docs: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """(doc_id, label, template, base, start, end): one row for each place where a template's wording stands.

    template is its number, base phrases first; words are numbered from 0 and
    end is exclusive.  Null and empty texts give no rows.
    """
    automaton = automaton or Automaton.build()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i.as_py(), automaton.labels[t], t, t < automaton.base, a, z)
                    for i, text in zip(b.column(0), b.column(1)) for a, t, z in automaton.places(words(text.as_py()))]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                             ["doc_id", "label", "template", "base", "start", "end"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _utf8(F.col("text"))).mapInArrow(
        run, "doc_id long, label string, template int, base boolean, start long, end long")


_SCHEMA = (("doc_id", "long", pa.int64()), ("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()),
           ("first_word", "long", pa.int64()), ("last_word", "long", pa.int64()), ("base_labels", "string", pa.string()),
           ("labels", "string", pa.string()), ("score", "double", pa.float64()))


def annotate(docs: DataFrame, automaton: Automaton | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of base phrases, first_word and last_word are
    their smallest and largest start (null without one); labels holds the base
    labels and those of accepted templates; label lists are empty strings where
    nothing is found, the score is then 0.  Whole texts are read.  A null text
    is an empty one.  Repeated rows give equal rows, null ids stay null, an empty
    table gives an empty one; other columns are ignored.  No shuffle.
    """
    automaton = automaton or Automaton.build()

    def one(doc_id: int | None, text: bytes) -> tuple:
        own = words(text)
        found = automaton.places(own)
        base = [(a, t) for a, t, _ in found if t < automaton.base]
        starts = [a for a, _ in base]
        return (doc_id, len(own), len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({automaton.labels[t] for _, t in base})), ",".join(sorted({automaton.labels[t] for _, t, _ in found})),
                score([automaton.sizes[t] for _, t, _ in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(i.as_py(), text.as_py()) for i, text in zip(b.column(0), b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, (_, _, k) in enumerate(_SCHEMA)], [n for n, _, _ in _SCHEMA])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _utf8(F.col("text"))).mapInArrow(
        run, ", ".join(f"{n} {k}" for n, k, _ in _SCHEMA))


def pattern(items: Sequence) -> str:
    """A regular expression for a template, over words that each end in a blank (for the SQL twin)."""
    out = ""
    for x in items:
        if isinstance(x, bytes):
            out += x.decode() + " "
        elif isinstance(x, Free):
            out += f"(?:[^ ]+ ){{{int(x.least)},{x.most}}}"
        else:
            out += "(?:" + "|".join(pattern(way) for way in x.ways) + ")"
    return out


def _sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base = [(label, phrase.split()) for label, phrase in BASE]
    starts = " || ".join(
        f"list_filter(range(len(w) - {len(p) - 1}), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p)) + ")" for _, p in base)
    every = [(label, parse(markup)) for label, markup in (*BASE, *TEMPLATES)]
    rows = ",\n    ".join(f"('{label}', ' {pattern(items)}', {score([mandatory(items)])!r}, {str(i < len(BASE)).upper()})" for i, (label, items) in enumerate(every))
    return f"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
placed AS (SELECT doc_id, w, {starts} AS starts FROM cut),
templates(label, pattern, score, base) AS (VALUES
    {rows}
),
met AS (
  SELECT doc_id, label, score, base FROM (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS line FROM cut), templates WHERE regexp_matches(line, pattern)
),
told AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         max(score) AS score FROM met GROUP BY doc_id
)
SELECT p.doc_id, len(w)::BIGINT AS n_words, len(starts)::BIGINT AS n_base, list_min(starts)::BIGINT AS first_word, list_max(starts)::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM placed p LEFT JOIN told USING (doc_id)
"""


SQL = _sql()
