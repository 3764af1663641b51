"""Licence scans with a generalised suffix automaton.

The automaton is built from the words of licence templates. A text is streamed through
it: for every word, the longest run of words that ends there and occurs in some template
(its matching statistic). Runs that cannot be extended and have ``shortest`` words or
more are chained for each template: in the order of both the text and the template, not
too far apart. Chains that cover enough of the template give its label; a template can
have several in a text, the heaviest first, that do not overlap.

Words outside the templates reset the automaton, so a text is cut at them first, and
only stretches of template words are walked word by word.

Defined results: words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z; a null
text has none. Without a match the labels are empty strings, the score is 0 and the
places are null. Rows are independent: repeated rows and rows without an id are scanned
like others. Ties between chains go to the longer, then the earlier. Other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bpe import steps
from tidegate.llm.textkit import IS_BREAK, Texts, Words, runs, span_hash

# The phrases whose places are counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Wordings of well-known licence notices.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved."),
)

SHORTEST = 3
#: Share of a template that a chain must cover, and the words of a text it may skip between two runs.
SHARE = 0.6
GAP = 20
RESULT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:bigint,stop:bigint,share:double>>"
)


def hashed_words(text: str) -> list[int]:
    texts = Texts(pa.array([text]), lower=True)
    words = Words(texts, IS_BREAK)
    return span_hash(texts.buf, words.begin, words.end).tolist()


class SuffixAutomaton:
    """Of several word sequences; a state knows, for each template, where its words end in it, and where first."""

    def __init__(self, sequences: list[list[int]]):
        self.arcs: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[dict[int, set[int]]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.places[last].setdefault(number, set()).add(at)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            for number, at in self.places[state].items():
                self.places[self.link[state]].setdefault(number, set()).update(at)
        self.ends = [{number: min(at) for number, at in x.items()} for x in self.places]

    def _new(self, arcs: dict[int, int], link: int, length: int) -> int:
        self.arcs.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.places.append({})
        return len(self.arcs) - 1

    def _split(self, state: int, word: int) -> int:
        """The state that words of the length one past ``state`` have, made from a longer one if need be."""
        target = self.arcs[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(dict(self.arcs[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.arcs[state].get(word) == target:
            self.arcs[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.arcs[last]:
            return self._split(last, word)
        new = self._new({}, 0, self.length[last] + 1)
        while last >= 0 and word not in self.arcs[last]:
            self.arcs[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place, length, state) of the longest match that ends at each word."""
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in self.arcs[state]:
                state = self.link[state]
                length = self.length[state]
            following = self.arcs[state].get(word)
            if following is None:
                length = 0
            else:
                state, length = following, length + 1
            yield place, length, state

    def matches(self, words: list[int], shortest: int) -> list[tuple[int, int, int]]:
        """(place after the end, length, state) of the matches that the next word does not extend."""
        out, before = [], (0, 0, 0)
        for place, length, state in self.statistics(words):
            if before[1] >= shortest and length <= before[1]:
                out.append(before)
            before = (place + 1, length, state)
        return [*out, before] if before[1] >= shortest else out


def chain_ends(pieces: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(covered words, start, stop) of the heaviest chain that ends with each (start, length, template start) piece."""
    best: list[tuple[int, int, int]] = []
    longest = max((x[1] for x in pieces), default=0)
    for i, (start, length, home) in enumerate(pieces):
        weight, origin = length, start
        for j in range(i - 1, -1, -1):
            s, n, h = pieces[j]
            if start - (s + n) > gap + longest:  # pieces come in the order of their ends
                break
            if s + n <= start <= s + n + gap and h + n <= home and best[j][0] + length > weight:
                weight, origin = best[j][0] + length, best[j][1]
        best.append((weight, origin, start + length))
    return best


def best_chain(pieces: list[tuple[int, int, int]], gap: int) -> tuple[int, int, int]:
    """(covered words, start, stop) of the heaviest chain of (start, length, template start) pieces."""
    return max(chain_ends(pieces, gap), key=lambda x: (x[0], -x[1], x[2]), default=(0, 0, 0))


def all_chains(pieces: list[tuple[int, int, int]], gap: int, least: float, shortest: int) -> list[tuple[int, int, int]]:
    """(covered words, start, stop) of chains of ``least`` words or more that do not overlap, the heaviest first.

    What the chosen ones leave of the pieces is chained again until nothing is heavy enough.
    """
    out: list[tuple[int, int, int]] = []
    open_ = [pieces]
    while open_:
        own = open_.pop()
        taken: list[tuple[int, int]] = []
        for weight, start, stop in sorted(chain_ends(own, gap), key=lambda x: (-x[0], x[1], -x[2])):
            if weight < least:
                break
            at = bisect_left(taken, (start, stop))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or stop <= taken[at][0]):
                taken.insert(at, (start, stop))
                out.append((weight, start, stop))
        if not taken:
            continue
        # the parts of the pieces that lie between two chosen chains
        edges = [0, *(x for pair in taken for x in pair)]
        left: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, home in own:
            k = max(0, bisect_right(edges, start) - 1)
            while k < len(edges) and edges[k] < start + length:
                stop = edges[k + 1] if k + 1 < len(edges) else start + length
                a, b = max(start, edges[k]), min(start + length, stop)
                if k % 2 == 0 and b - a >= shortest:
                    left.setdefault(k, []).append((a, b - a, home + a - start))
                k += 1
        open_ += [sorted(x, key=lambda p: (p[0] + p[1], p)) for x in left.values()]
    return out


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], shortest: int):
        self.labels = [label for label, _ in templates]
        sequences = [hashed_words(text) for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        self.known = np.array(sorted({w for s in sequences for w in s}), np.uint64)
        self.machine = SuffixAutomaton(sequences)
        self.shortest = shortest

    def chains(self, words: list[int], at: int, share: float, gap: int) -> list[tuple[str, int, int, float]]:
        """(label, start, stop, share) of the templates that a stretch of known words covers."""
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, state in self.machine.matches(words, self.shortest):
            for number, homes in self.machine.places[state].items():
                pieces.setdefault(number, []).extend((at + end - length, length, home + 1 - length) for home in sorted(homes))
        out = []
        for number, own in pieces.items():
            for covered, start, stop in all_chains(own, gap, share * self.sizes[number] - 1e-9, self.shortest):
                out.append((self.labels[number], start, stop, min(1.0, covered / self.sizes[number])))
        return out


def license_scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    shortest: int = SHORTEST,
    share: float = SHARE,
    gap: int = GAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Places and labels of licence phrases, labels of covered templates, and the covered spans (word places).

    ``score`` is the largest share of a template that a text covers, 1 where a phrase stands.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, shortest)
        wanted = [(np.array(hashed_words(p), np.uint64), label) for p, label in phrases]
        for batch in batches:
            for part in steps(batch, "text"):
                yield scan_step(part, scanner, wanted)

    def scan_step(part: pa.RecordBatch, scanner: Scanner, wanted: list[tuple[np.ndarray, str]]) -> pa.RecordBatch:
        texts = Texts(part.column("text"), lower=True)
        words = Words(texts, IS_BREAK)
        hashes = span_hash(texts.buf, words.begin, words.end)
        n = len(texts)
        place, label = [], []
        for phrase, name in wanted:
            hit = words.window_ok(len(phrase))
            for k, word in enumerate(phrase):
                hit[: len(hashes) - k] &= hashes[k:] == word
            place.append(np.flatnonzero(hit))
            label += [name] * len(place[-1])
        place = np.concatenate(place)
        owner = words.text[place]
        n_base = np.bincount(owner, minlength=n)
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        own_place = place - words.first[owner]
        np.minimum.at(first, owner, own_place)
        np.maximum.at(last, owner, own_place)
        base: list[set[str]] = [set() for _ in range(n)]
        for i, name in zip(owner.tolist(), label, strict=True):
            base[i].add(name)
        # stretches of template words that stay in one text, words of up to ``gap`` others between them allowed
        at = np.minimum(np.searchsorted(scanner.known, hashes), len(scanner.known) - 1)
        known = scanner.known[at] == hashes
        begin, end = _stretches(known, words, scanner.shortest, gap)
        spans: list[list[tuple[str, int, int, float]]] = [[] for _ in range(n)]
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            i = int(words.text[a])
            spans[i] += scanner.chains(hashes[a:b].tolist(), a - int(words.first[i]), share, gap)
        has = pa.array(n_base == 0)
        score = [1.0 if k else max((s[3] for s in found), default=0.0) for k, found in zip(n_base.tolist(), spans, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(words.count, pa.int64()),
                pa.array(n_base, pa.int64()),
                pa.array(first, pa.int64(), mask=has.to_numpy(zero_copy_only=False)),
                pa.array(last, pa.int64(), mask=has.to_numpy(zero_copy_only=False)),
                pa.array([",".join(sorted(x)) for x in base], pa.string()),
                pa.array([",".join(sorted(x | {s[0] for s in found})) for x, found in zip(base, spans, strict=True)], pa.string()),
                pa.array(score, pa.float64()),
                pa.array(
                    [[dict(zip(("label", "start", "stop", "share"), s, strict=True)) for s in sorted(found, key=lambda s: s[1:3] + s[:1])] for found in spans],
                    pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("share", pa.float64())])),
                ),
            ],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, RESULT)


def _stretches(known: np.ndarray, words: Words, shortest: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of runs of known words, joined over gaps, that hold one run of ``shortest`` words."""
    begin, end = runs(known)
    cuts = words.first[(words.first > 0) & (words.first < len(known)) & (words.count > 0)]
    cuts = cuts[known[cuts] & known[cuts - 1]]
    begin, end = np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
    long_enough = end - begin >= shortest
    begin, end = begin[long_enough], end[long_enough]
    if not len(begin):
        return begin, end
    apart = (begin[1:] - end[:-1] > gap) | (words.text[begin[1:]] != words.text[begin[:-1]])
    return begin[np.append(True, apart)], end[np.append(apart, True)]
