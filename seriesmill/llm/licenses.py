"""License scan by templates with optional and replaceable regions.

A template is plain wording with two kinds of mark-up::

    licensed under [the terms of] the <1-3> license

``[...]`` may be left out (and may be nested), ``<a-b>`` stands for a to b words of any
kind. All templates become one automaton over words, whose deterministic states are made
when a text first needs them. A text has the label of a template if the template's
mandatory wording, and nothing else but its regions, stands somewhere in it word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesmill.llm.common import WORD_BREAK, flat, lower_ascii, pieces, prefix_sums, span_hashes, word_spans


@dataclass(frozen=True)
class Template:
    label: str
    wording: str
    #: A plain phrase whose places are counted.
    base: bool = False


# Phrases and their labels.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
# Wording of public licenses and of the notices that name them.
TEMPLATES = (
    Template("mit", "[this <1-4> is] [released] [licensed] [distributed] under [the terms of] the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files [the software] to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0 [the license]"),
    Template(
        "apache-2.0",
        "you may not use <1-6> except in compliance with the license you may obtain a copy of the license at <0-2> "
        "www apache org licenses license 2 0",
    ),
    Template("gpl-3.0", "[licensed] under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 3 [of the license]"),
    Template("gpl-3.0-or-later", "gnu general public license [as published by the free software foundation] [either] version 3 [of the license] or [at your option] any later version"),
    Template("gpl-2.0", "under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 2 [of the license]"),
    Template("lgpl", "under [the terms of] the gnu [<1-1>] lesser general public license [as published by the free software foundation] [either] version <1-2>"),
    Template("cc-by-nc-4.0", "licensed under [a] [the] cc by nc [sa] [nd] 4 0"),
    Template("cc-by-4.0", "licensed under [a] [the] [creative commons attribution] cc by 4 0"),
    Template("cc-by", "licensed under [a] [the] creative commons attribution [<1-3>] [international] license"),
    Template("cc0", "to the extent possible under law <1-12> has waived all copyright and related or neighboring rights to"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met [1] redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer",
    ),
    Template("bsd-3-clause", "neither the name of <1-12> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    Template("isc", "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("spdx-mit", "spdx license identifier mit"),
    Template("spdx-apache-2.0", "spdx license identifier apache 2 0"),
    Template("spdx-gpl-3.0", "spdx license identifier gpl 3 0 [only] [or later]"),
    Template("all-rights-reserved", "copyright [c] <1-12> all rights reserved"),
)

_TOKEN = re.compile(r"\[|\]|<(\d+)-(\d+)>|[^\[\]<>\s]+")


def parsed(wording: str) -> list:
    """Items of a template: a word, ``(least, most)`` words of any kind, or a list that may be left out."""
    stack: list[list] = [[]]
    for found in _TOKEN.finditer(wording):
        token = found.group()
        if token == "[":
            stack.append([])
        elif token == "]":
            if len(stack) == 1:
                raise ValueError(f"] without [ in: {wording}")
            region = stack.pop()
            stack[-1].append(region)
        elif found.group(1):
            least, most = int(found.group(1)), int(found.group(2))
            if least > most or not most:
                raise ValueError(f"no words in {token} of: {wording}")
            stack[-1].append((least, most))
        else:
            stack[-1].append(token)
    if len(stack) > 1:
        raise ValueError(f"[ without ] in: {wording}")
    if not mandatory(stack[0]):
        raise ValueError(f"nothing mandatory in: {wording}")
    return stack[0]


def mandatory(items: list) -> int:
    """Words of fixed wording that can't be left out."""
    return sum(isinstance(i, str) for i in items)


class Automaton:
    """Reads words as numbers: 0 is the end of a text, 1 any word of no template."""

    #: States kept; beyond, they are made anew as texts need them.
    MOST = 20_000

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.weights = np.array([mandatory(parsed(t.wording)) for t in templates])
        self.words: dict[str, int] = {}
        #: Of each place: places reachable without a word, by a given word, and by any word.
        self._free: list[list[int]] = []
        self._by: list[dict[int, int]] = []
        self._any: list[int | None] = []
        self._ends: dict[int, int] = {}
        self.first = self._place()
        for k, t in enumerate(templates):
            begin = self._place()
            self._free[self.first].append(begin)
            self._ends[self._chain(begin, parsed(t.wording))] = k
        self._forget()

    def _place(self) -> int:
        self._free.append([])
        self._by.append({})
        self._any.append(None)
        return len(self._free) - 1

    def _chain(self, at: int, items: list) -> int:
        for item in items:
            if isinstance(item, str):
                word = self.words.setdefault(item, len(self.words) + 2)
                to = self._place()
                self._by[at][word] = to
            elif isinstance(item, list):
                inner, to = self._place(), self._place()
                self._free[at] += [inner, to]
                self._free[self._chain(inner, item)].append(to)
            else:
                least, most = item
                to = self._place()
                for k in range(most):
                    if k >= least:
                        self._free[at].append(to)
                    after = self._place()
                    self._any[at] = after
                    at = after
                self._free[at].append(to)
            at = to
        return at

    def _closed(self, places: set[int]) -> frozenset[int]:
        found, left = set(places), list(places)
        while left:
            for to in self._free[left.pop()]:
                if to not in found:
                    found.add(to)
                    left.append(to)
        return frozenset(found)

    def _forget(self) -> None:
        self._sets: list[frozenset[int]] = []
        self._number: dict[frozenset[int], int] = {}
        self.step = np.full((0, len(self.words) + 2), -1, np.int32)
        self.ends: list[tuple[int, ...]] = []
        self.ending = np.zeros(0, bool)
        self._state(frozenset())  # 0: nothing can follow
        self._state(self._closed({self.first}))  # 1: the beginning

    def _state(self, places: frozenset[int]) -> int:
        number = self._number.get(places)
        if number is None:
            number = self._number[places] = len(self._sets)
            self._sets.append(places)
            self.ends.append(tuple(sorted(self._ends[p] for p in places if p in self._ends)))
            if number >= len(self.step):
                more = max(64, len(self.step))
                self.step = np.vstack((self.step, np.full((more, self.step.shape[1]), -1, np.int32)))
                self.ending = np.concatenate((self.ending, np.zeros(more, bool)))
            self.ending[number] = bool(self.ends[number])
        return number

    def follow(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The state after one more word, for many places of texts at a time."""
        to = self.step[states, words]
        new = np.flatnonzero(to < 0)
        if len(new):
            for code in np.unique(states[new].astype(np.int64) << 32 | words[new]):
                state, word = int(code >> 32), int(code & 0xFFFFFFFF)
                places = self._sets[state]
                onto = set()
                if word:
                    onto = {self._by[p][word] for p in places if word in self._by[p]} | {self._any[p] for p in places if self._any[p] is not None}
                self.step[state, word] = self._state(self._closed(onto))
            to = self.step[states, words]
        return to

    def matches(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and template of all matches in texts that each end with a 0."""
        if len(self._sets) > self.MOST:
            self._forget()
        state = self.follow(np.ones(len(words), np.int32), words)
        start = np.flatnonzero(state)
        state, at = state[start], start + 1
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(start):
            for number in np.unique(state[self.ending[state]]):
                some = state == number
                for k in self.ends[number]:
                    found.append((start[some], at[some], np.full(some.sum(), k)))
            state = self.follow(state, words[at])
            alive = state > 0
            start, at, state = start[alive], at[alive] + 1, state[alive]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Reader:
    """Texts to numbers of an automaton's words; equal hashes are confirmed byte by byte."""

    #: Bytes whose hashes are held at once.
    STRETCH = 1 << 20

    def __init__(self, automaton: Automaton):
        vocabulary = [w.encode() for w in automaton.words]
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary])
        sizes = np.diff(ends, prepend=0)
        hashes = span_hashes(prefix_sums(data), ends - sizes, ends)
        order = np.argsort(hashes)
        self._hashes, self._number, self._sizes = hashes[order], (order + 2).astype(np.int32), sizes[order]
        self._width = int(sizes.max())
        self._bytes = np.zeros((len(order), self._width), np.uint8)
        for k, o in enumerate(order):
            self._bytes[k, : sizes[o]] = data[ends[o] - sizes[o] : ends[o]]

    def _numbers(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashes = span_hashes(prefix_sums(data), begin, end)
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        out = np.ones(len(begin), np.int32)
        some = np.flatnonzero((self._hashes[at] == hashes) & (self._sizes[at] == end - begin))
        at, begin, size = at[some], begin[some], (end - begin)[some]
        same = np.ones(len(some), bool)
        for k in range(self._width):
            inside = np.flatnonzero(size > k)
            same[inside] &= data[begin[inside] + k] == self._bytes[at[inside], k]
        out[some[same]] = self._number[at[same]]
        return out

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, a 0 after each text, and the words of each text."""
        data, starts = flat(column)
        parts, owners = [], []
        at = 0
        while at < len(data):
            to = min(len(data), at + self.STRETCH)
            while to < len(data):  # not inside a word, unless a text ends there
                rest = WORD_BREAK[lower_ascii(data[at:to])]
                last = np.flatnonzero(rest[::-1])[:1]
                if len(last) and last[0] < to - at - 1:
                    to -= int(last[0])
                    break
                to = min(len(data), to + self.STRETCH)
            low = lower_ascii(data[at:to])
            cuts = np.concatenate(([0], starts[(starts > at) & (starts < to)] - at, [to - at]))
            begin, end, _ = word_spans(low, cuts, WORD_BREAK)
            parts.append(self._numbers(low, begin, end))
            owners.append(np.searchsorted(starts, begin + at, "right") - 1)
            at = to
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        count = np.bincount(owner, minlength=len(column)).astype(np.int64)
        out = np.zeros(len(numbers) + len(column), np.int32)
        out[np.arange(len(numbers)) + owner] = numbers
        return out, count


def _joined(labels: set[str]) -> str:
    return ",".join(sorted(labels))


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = PHRASES + TEMPLATES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of each row of ``docs``.

    Words are runs of ASCII letters (in lower case), digits and all other signs beyond
    ASCII. ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word``
    are the smallest and largest word a place starts at. ``score`` is m / (m + 1) for the
    m mandatory words of the longest template found, 0 without one: longer wording says more.

    A null or empty text has no words, labels or places. Every row of ``docs`` gives
    a row, also those with the same or no doc_id; other columns are ignored. Rows need no
    other rows, so nothing is shuffled. Of a very long text only the numbers of its words
    (4 bytes each) are held beside it; a single word is held whole.
    """
    n_base = [t.base for t in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(templates)
        reader, is_base, weights = Reader(automaton), np.array(n_base), automaton.weights
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, count = reader.read(piece.column("text"))
                n = piece.num_rows
                begin = np.concatenate(([0], np.cumsum(count + 1)))[:-1]
                start, _, which = automaton.matches(words)
                owner = np.searchsorted(begin, start, "right") - 1
                longest = np.zeros(n, np.int64)
                np.maximum.at(longest, owner, weights[which])
                labels: list[list[set[str]]] = [[set() for _ in range(n)] for _ in range(2)]
                for o, k in set(zip(owner.tolist(), which.tolist(), strict=True)):
                    labels[0][o].add(templates[k].label)
                    if templates[k].base:
                        labels[1][o].add(templates[k].label)
                place, of = (start - begin[owner])[is_base[which]], owner[is_base[which]]
                places = np.bincount(of, minlength=n).astype(np.int64)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(low, of, place)
                np.maximum.at(high, of, place)
                none = places == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array(count), pa.array(places), pa.array(low, mask=none), pa.array(high, mask=none),
                        pa.array([_joined(x) for x in labels[1]], pa.string()), pa.array([_joined(x) for x in labels[0]], pa.string()), pa.array(longest / (longest + 1.0)),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.selectExpr("cast(doc_id as long) as doc_id", f"`{text}` as text").mapInArrow(run, schema)
