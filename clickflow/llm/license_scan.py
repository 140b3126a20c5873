"""License scans with a generalised suffix automaton of licence templates.

The templates' words (and the base phrases) make one suffix automaton, built on
the driver from a list of fixed size and broadcast.  A text streams through it
once.  After each word the automaton's state and a length tell the longest run
of words, ending there, that any template holds (matching statistics).  Runs
that do not go on with the next word are matches.  Matches of ``MIN_MATCH``
words or more are chained per template, in the order of both text and
template, over gaps of at most ``GAP`` words on either side, so that changed
names, years or a lost line do not break a notice.  A chain is a span if it
covers ``COVER`` of the template's words.

A base phrase occurs where the automaton stands at the phrase's state, or
below it in the tree of suffix links, with at least its length.
"""
from __future__ import annotations

import bisect
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_MATCH = 4        # words of a match that may be chained
GAP = 12             # words between chained matches, in text and in template
COVER = 0.6          # share of a template's words that makes a span
BASE_SCORE = 0.5     # least score of a text with a base phrase
BLOCK = 1 << 20      # bytes of a text whose words are listed at a time
MAX_TEMPLATE_WORDS = 2_000_000  # of all templates: the automaton is broadcast, about 1 kB a word

#: Bytes of words: digits, lower-case letters (after ASCII lower-casing) and all bytes of characters beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")


class Template(NamedTuple):
    label: str
    text: str


#: Phrases that count wherever their words stand consecutively.
PHRASES = [Template("mit", "mit license"), Template("apache", "apache license"), Template("gpl", "general public license")]

#: Notices as projects write them and the operative text of short licences.
TEMPLATES = [
    Template("mit", "Released under the MIT License."),
    Template("mit", "This project is licensed under the terms of the MIT license."),
    Template("mit", "SPDX-License-Identifier: MIT"),
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""),
    Template("apache", "Licensed under the Apache License, Version 2.0."),
    Template("apache", "SPDX-License-Identifier: Apache-2.0"),
    Template("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl", "This work is licensed under the GNU General Public License, version 2."),
    Template("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    Template("gpl", "SPDX-License-Identifier: GPL-2.0-only"),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    Template("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
Lesser General Public License as published by the Free Software Foundation."""),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    Template("cc-by", "Licensed under CC BY 4.0."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights."),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    Template("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    Template("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software."""),
]


def words_of(data: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, ASCII letters in lower case, a list per ``block`` bytes or a little more."""
    data, at = data.lower(), 0
    while at < len(data):
        stop = _NO_WORD.search(data, min(at + block, len(data)))
        end = stop.start() if stop else len(data)
        yield _WORD.findall(data, at, end)
        at = end + 1


class SuffixAutomaton:
    """Generalised: one automaton for all word sequences, each walked from the root."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        if sum(map(len, sequences)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words of templates to broadcast")
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, words read) of the prefixes that end in the state
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
                self.ends[last].append((number, at + 1))
        self.below: list[list[int]] = [[] for _ in self.link]
        for state, up in enumerate(self.link):
            if up >= 0:
                self.below[up].append(state)
        self._places: dict[int, list[tuple[int, int]]] = {}

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _extend(self, last: int, word: int) -> int:
        have = self.next[last].get(word)
        if have is not None:  # the sequence so far occurs in an earlier one
            return have if self.length[have] == self.length[last] + 1 else self._clone(last, word, have)
        new, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._clone(at, word, to)
        return new

    def _clone(self, at: int, word: int, to: int) -> int:
        """The shorter sequences of ``to``, as a state of their own."""
        copy = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def places(self, state: int) -> list[tuple[int, int]]:
        """(sequence, end) of all occurrences of the state's word runs."""
        known = self._places.get(state)
        if known is None:
            known, stack = [], [state]
            while stack:
                s = stack.pop()
                known += self.ends[s]
                stack += self.below[s]
            known.sort()
            self._places[state] = known
        return known

    def state_of(self, words: Sequence[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][self.ids[word]]
        return state


class Span(NamedTuple):
    label: str
    first_word: int
    last_word: int
    covered: int
    coverage: float


class Scan(NamedTuple):
    n_words: int
    base: list[tuple[int, str]]  # (start, label) of each place of a base phrase
    spans: list[Span]


class Scanner:
    """The automaton of phrases and templates, and what a text holds of them."""

    def __init__(self, phrases: Sequence[Template] = tuple(PHRASES), templates: Sequence[Template] = tuple(TEMPLATES)):
        listed = [[w for ws in words_of(t.text.encode()) for w in ws] for t in [*phrases, *templates]]
        if not all(listed):
            raise ValueError("a phrase or template without words")
        self.n_phrases, self.labels = len(phrases), [t.label for t in [*phrases, *templates]]
        self.sizes = [len(words) for words in listed]
        self.automaton = SuffixAutomaton(listed)
        own: dict[int, list[tuple[int, str]]] = {}
        for words, phrase in zip(listed, phrases):
            own.setdefault(self.automaton.state_of(words), []).append((len(words), phrase.label))
        #: Base phrases that end wherever the automaton is in a state: its own and those of its suffix links.
        self.base: list[list[tuple[int, str]]] = [[] for _ in self.automaton.link]
        for state in sorted(range(len(self.base)), key=self.automaton.length.__getitem__):
            up = self.automaton.link[state]
            self.base[state] = own.get(state, []) + (self.base[up] if up >= 0 else [])

    def scan(self, text: str) -> Scan:
        base: list[tuple[int, str]] = []
        chains = _Chains(self)
        n = 0
        for position, state, length, ended in self._statistics(text):
            if position < 0:
                n = ended
                continue
            if length:
                base += [(position - size + 1, label) for size, label in self.base[state] if size <= length]
            if ended:
                chains.add(position, *ended)
        return Scan(n, base, chains.spans())

    def _statistics(self, text: str) -> Iterator[tuple]:
        """(position, state, length, match that ended before it) where a template has the word or a match ended.

        A match is (state, length) and ends one word before the position.  The last row is (-1, 0, 0, number of words).
        """
        a = self.automaton
        ids, edges, link, size = a.ids.get, a.next, a.link, a.length
        state = length = n = 0
        for words in words_of(text.encode()):
            for position, word in enumerate(map(ids, words), n):
                if word is None:
                    if length:
                        yield position, 0, 0, (state, length) if length >= MIN_MATCH else None
                        state = length = 0
                    continue
                before = state, length
                while state and word not in edges[state]:
                    state = link[state]
                    length = size[state]
                if word in edges[state]:
                    state = edges[state][word]
                    length += 1
                broken = before[1] >= MIN_MATCH and length <= before[1]
                yield position, state, length, before if broken else None
            n += len(words)
        if length >= MIN_MATCH:
            yield n, 0, 0, (state, length)
        yield -1, 0, 0, n


class _Chains:
    """Matches of one text, chained per template; only chains that may still go on are looked at."""

    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.open: dict[int, list[tuple]] = {}   # template: (start, end, template end, covered) of chains
        self.best: dict[int, list[tuple]] = {}   # template: chains that reach the coverage

    def add(self, end: int, state: int, length: int) -> None:
        """A match of ``length`` words before word ``end``."""
        s = self.scanner
        start = end - length
        fresh: dict[int, list[tuple]] = {}
        for template, stop in s.automaton.places(state):
            if template < s.n_phrases:
                continue
            begin, found = stop - length, (start, end, stop, length)
            for c_start, c_end, c_stop, c_covered in self.open.get(template, ()):
                skip = max(0, c_end - start, c_stop - begin)  # words that the chain has already
                if skip < length and c_stop < stop and start - c_end <= GAP and begin - c_stop <= GAP:
                    longer = c_start, end, stop, c_covered + length - skip
                    found = max(found, longer, key=lambda c: (c[3], -c[0]))
            fresh.setdefault(template, []).append(found)
            if found[3] >= COVER * s.sizes[template]:
                self.best.setdefault(template, []).append(found)
        for template, chains in fresh.items():
            kept = [c for c in self.open.get(template, ()) if end - c[1] <= GAP + s.sizes[template]]
            self.open[template] = kept + chains

    def spans(self) -> list[Span]:
        """Of overlapping chains of a label the one with the largest coverage, then the longest, then the first."""
        s, found = self.scanner, []
        for template, chains in self.best.items():
            size = s.sizes[template]
            found += [(s.labels[template], start, end - 1, covered, min(1.0, covered / size))
                      for start, end, _, covered in chains]
        kept: list[Span] = []
        taken: dict[str, list[tuple[int, int]]] = {}  # label: (first, last) of the kept spans, in order
        for span in sorted(map(Span._make, set(found)), key=lambda x: (-x.coverage, -x.covered, x)):
            ranges = taken.setdefault(span.label, [])
            at = bisect.bisect(ranges, (span.first_word, span.last_word))
            clear = at == 0 or ranges[at - 1][1] < span.first_word
            if clear and (at == len(ranges) or ranges[at][0] > span.last_word):
                ranges.insert(at, (span.first_word, span.last_word))
                kept.append(span)
        return sorted(kept, key=lambda x: (x.first_word, x.last_word, x.label))


_SCANNERS: dict[tuple, Scanner] = {}  # one per Python worker


def _scanner(key: tuple, shared) -> Scanner:
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(*shared.value)
    return _SCANNERS[key]


def scan_licenses(docs: DataFrame, doc: str = "doc_id", text: str = "text", phrases: Sequence[Template] = tuple(PHRASES),
                  templates: Sequence[Template] = tuple(TEMPLATES)) -> DataFrame:
    """Per row: ``doc``, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``n_base`` counts all places of base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest start of one (words from 0;
    null without any), ``base_labels`` their labels, ``labels`` also those of
    the spans (distinct, sorted, comma-joined).  ``spans`` are the covered
    stretches of templates: label, first and last word, covered words, share
    of the template.  ``score`` is the largest share, and ``BASE_SCORE`` at
    least with a base phrase.

    Null texts are empty; texts without words have zeros, nulls and empty
    strings.  Repeated rows and null keys give a row each, an empty table
    none, other columns are ignored.  Rows are independent: no shuffle.  A
    text's words are listed a megabyte at a time.
    """
    key = tuple(phrases), tuple(templates)
    shared = docs.sparkSession.sparkContext.broadcast(key)
    slim = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                      ("covered", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared)
        for batch in batches:
            scans = [scanner.scan(t.as_py()) for t in batch.column("text")]
            starts = [[at for at, _ in s.base] for s in scans]
            base = [sorted({label for _, label in s.base}) for s in scans]
            every = [sorted({*b, *(x.label for x in s.spans)}) for b, s in zip(base, scans)]
            scores = [max([x.coverage for x in s.spans] + [BASE_SCORE * bool(s.base)]) for s in scans]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array([s.n_words for s in scans], pa.int64()),
                pa.array([len(s) for s in starts], pa.int64()), pa.array([min(s, default=None) for s in starts], pa.int64()),
                pa.array([max(s, default=None) for s in starts], pa.int64()), pa.array(list(map(",".join, base)), pa.string()),
                pa.array(list(map(",".join, every)), pa.string()), pa.array(scores, pa.float64()),
                pa.array([[x._asdict() for x in s.spans] for s in scans], pa.list_(span))], names=names)

    names = ["doc", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    schema = (f"doc {dict(slim.dtypes)['doc']}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
              "base_labels string, labels string, score double, "
              "spans array<struct<label: string, first_word: bigint, last_word: bigint, covered: bigint, coverage: double>>")
    return slim.mapInArrow(run, schema).withColumnRenamed("doc", doc)
