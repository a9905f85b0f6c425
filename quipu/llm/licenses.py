"""Licence scans: matching statistics against a generalised suffix automaton of licence tokens.

The automaton holds every token run of every template.  A text streams through it
word by word; at each word the state gives the longest run ending there that some
template contains.  Runs of ``MIN_RUN`` words or more are chained, in text order and
template order with small gaps, into covered spans.  A span covering at least
``MIN_COVER`` of its template gives that template's label, if it is no near miss: it holds
the words by which licences are told apart (names, and the version where the label has
one) or at least no other version in their place, no name that the template lacks stands
between its runs, and in a template of fewer than ``SHORT`` words none of them is missing
and no word at all is inserted.  Where spans of different labels overlap,
the one with the most covered and the fewest inserted words stays.  A near miss scores
``NEAR_MISS`` at most.

Besides, three phrases of fixed labels are counted wherever their words follow each
other.

Defined cases: a null or empty text has no words, no labels and score zero; repeated
texts get equal results; overlapping or repeated spans are all listed, labels once;
empty tables give empty tables.  Columns other than id and text are not read.
"""

from __future__ import annotations

import functools
import re
import string
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_RUN = 3
MAX_GAP = 10
MIN_COVER = 0.6
SHORT = 15
NEAR_MISS = 0.5
PIECE = 1 << 20

#: Words that name a licence or a variant of one.
NAMES = frozenset(
    "academic affero apache artistic boost bsd cc cddl creative eclipse epl eupl gnu isc lesser lgpl agpl microsoft mit mozilla mpl nc "
    "nd noderivatives noderivs noncommercial sa sharealike unported zlib".split()
)

#: Phrases and labels of the contract.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Public licence notices, as label and text.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under "
        "the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("lgpl-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    (
        "agpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "lgpl-notice",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "boost-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "boost-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ),
    (
        "bsd",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED.",
    ),
    (
        "cc-by-4.0",
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
        'this Creative Commons Attribution 4.0 International Public License ("Public License").',
    ),
    (
        "cc-by-nc-4.0",
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
        'this Creative Commons Attribution-NonCommercial 4.0 International Public License ("Public License").',
    ),
    (
        "cc-by-sa-4.0",
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
        'this Creative Commons Attribution-ShareAlike 4.0 International Public License ("Public License").',
    ),
    (
        "cc0-1.0",
        "has waived all copyright and related or neighboring rights to this work",
    ),
    (
        "cc0-1.0",
        "To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, fully, "
        "permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related "
        "Rights and associated claims and causes of action, whether now known or unknown",
    ),
    (
        "epl-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "epl",
        'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, '
        "REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

_NUMBERS = frozenset(f"{v}{n}".encode() for n in range(100) for v in ("", "v"))
_TELLING = _NUMBERS | {n.encode() for n in NAMES}
_ASCII_WORD = set((string.ascii_letters + string.digits).encode())
#: A-Z become a-z, every other ASCII character that is no part of a word a blank.
_TABLE = bytes(ord(chr(b).lower()) if b < 128 and b in _ASCII_WORD else b if b >= 128 else 32 for b in range(256))


def split_words(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton; each state knows, per template, the places where its runs end.

    ``ends`` holds one of them, ``places`` all.
    """

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        self.places: list[dict[int, set[int]]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].setdefault(number, at + 1)
                self.places[last].setdefault(number, set()).add(at + 1)
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            above = self.ends[self.link[state]]
            for number, end in self.ends[state].items():
                above.setdefault(number, end)
            for number, ends in self.places[state].items():
                self.places[self.link[state]].setdefault(number, set()).update(ends)

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        self.places.append({})
        return len(self.length) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """A copy of ``target`` for the runs that reach it from ``state``."""
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        target = self.next[last].get(token)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, token, target)
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, token, target)
        return new

    def step(self, state: int, length: int, token: int) -> tuple[int, int]:
        """The longest run ending with the token that some template holds."""
        while state and token not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        target = self.next[state].get(token)
        return (0, 0) if target is None else (target, length + 1)


@dataclass
class Scan:
    """What one text holds; spans are (label, first word, end, share of the template)."""

    n_words: int = 0
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    spans: list[tuple[str, int, int, float]] = field(default_factory=list)
    score: float = 0.0


class Scanner:
    def __init__(self, templates: Iterable[tuple[str, str]] = TEMPLATES, phrases: Iterable[tuple[str, str]] = PHRASES):
        self.vocabulary: dict[bytes, int] = {}
        self.labels = [label for label, _ in templates]
        sequences = [self._codes(text) for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        self.required = [self._required(label, text) for label, text in templates]
        self.phrases = [(self._codes(phrase), label) for phrase, label in phrases]
        self.automaton = Automaton(sequences)

    def _codes(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in split_words(text.encode())]

    def _required(self, label: str, text: str) -> list[set[int]]:
        """Per word that tells the template from others, its places in it; one of them must be covered."""
        version = re.findall(r"\d+", label)
        places: dict[bytes, set[int]] = defaultdict(set)
        for at, word in enumerate(split_words(text.encode())):
            if word.decode() in NAMES or word.decode().removeprefix("v") in version:
                places[word].add(at)
        return list(places.values())

    def scan(self, text: str | None, piece: int = PIECE) -> Scan:
        out = Scan()
        known = self.vocabulary.get
        raw = (text or "").encode("utf-8", "surrogatepass")
        overlap = max(len(p) for p, _ in self.phrases) - 1
        matches: list[tuple[int, int, int]] = []  # (end, length, state)
        telling: list[tuple[int, bool]] = []  # places of names and of version numbers, known to templates or not
        state = length = 0
        last = -1
        carried = np.empty(0, np.int64)
        for part in _parts(raw, piece):
            words = split_words(part)
            codes = np.fromiter((known(w, -1) for w in words), np.int64, len(words))
            self._phrases(out, np.concatenate([carried, codes]), out.n_words - len(carried))
            telling += [(out.n_words + i, w in _NUMBERS) for i, w in enumerate(words) if w in _TELLING]
            for at in np.flatnonzero(codes >= 0):
                place, token = out.n_words + int(at), int(codes[at])
                if state and place != last + 1:
                    _keep(matches, last + 1, length, state)
                    state = length = 0
                before = (last + 1, length, state)
                state, length = self.automaton.step(state, length, token)
                if length <= before[1]:
                    _keep(matches, *before)
                last = place
            out.n_words += len(words)
            carried = np.concatenate([carried, codes])[-overlap:] if overlap else carried
        if state:
            _keep(matches, last + 1, length, state)
        self._chain(out, matches, telling)
        return out

    def _phrases(self, out: Scan, codes: np.ndarray, start: int) -> None:
        """Counts the phrases that end behind the words seen before."""
        for phrase, label in self.phrases:
            n = len(codes) - len(phrase) + 1
            if n <= 0:
                continue
            at = np.flatnonzero(np.logical_and.reduce([codes[i : n + i] == token for i, token in enumerate(phrase)])) + start
            at = at[at + len(phrase) > out.n_words]
            if len(at):
                out.n_base += len(at)
                out.first_word = int(at[0]) if out.first_word is None else min(out.first_word, int(at[0]))
                out.last_word = int(at[-1]) if out.last_word is None else max(out.last_word, int(at[-1]))
                out.base_labels.add(label)

    def _chain(self, out: Scan, matches: list[tuple[int, int, int]], telling: list[tuple[int, bool]]) -> None:
        by_template: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for end, length, state in matches:
            for template, ends in self.automaton.places[state].items():
                by_template[template] += [(end - length, end, to - length, to) for to in ends]
        spans: list[tuple[int, str, int, int, float]] = []
        for template, found in by_template.items():
            size = self.sizes[template]
            for start, end, covered, runs in _chains(found, size):
                share = min(1.0, covered / size)
                inserted = end - start - covered
                held = {p for _, _, at, to in runs for p in range(at, to)}
                within = telling[bisect_left(telling, (start,)) : bisect_left(telling, (end,))]
                between = {number for p, number in within if not any(a <= p < e for a, e, _, _ in runs)}
                missing = any(not held & places for places in self.required[template])
                # A long passage may lack a name, as where its link was cut out, but have no other version instead.
                near_miss = (size < SHORT and (inserted > 0 or missing)) or False in between or (missing and True in between)
                out.score = max(out.score, min(share, NEAR_MISS) if near_miss else share)
                if share >= MIN_COVER and not near_miss:
                    spans.append((covered - inserted, self.labels[template], start, end, share))
        out.spans = _best_aligned(spans)
        out.labels = out.base_labels | {s[0] for s in out.spans}


def _best_aligned(spans: list[tuple[int, str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """The spans without those that lie mostly under a better one of another label, by place."""
    kept: list[tuple[int, str, int, int, float]] = []
    by_start: list[tuple[int, int, str, int]] = []
    longest = max((s[3] - s[2] for s in spans), default=0)
    for span in sorted(spans, key=lambda s: (-s[0], s[2], s[1])):
        gain, label, start, end, _ = span
        low, high = bisect_left(by_start, (start - longest,)), bisect_left(by_start, (end,))
        if not any(
            other != label and better > gain and 2 * (min(end, e) - max(start, s)) > end - start
            for s, e, other, better in by_start[low:high]
        ):
            kept.append(span)
            insort(by_start, (start, end, label, gain))
    return [s[1:] for s in sorted(kept, key=lambda s: (s[2], s[3], s[1]))]


def _keep(matches: list[tuple[int, int, int]], end: int, length: int, state: int) -> None:
    if length >= MIN_RUN:
        matches.append((end, length, state))


def _parts(raw: bytes, size: int) -> Iterator[bytes]:
    """Pieces of the text that end at a blank, so no word is cut."""
    start = 0
    while len(raw) - start > size:
        end = raw.find(b" ", start + size)
        if end < 0:
            break
        yield raw[start:end]
        start = end
    yield raw[start:]


def _chains(found: list[tuple[int, int, int, int]], size: int) -> Iterator[tuple[int, int, int, list]]:
    """Runs of one template joined in order: (first word, end, words covered, runs).

    Each run goes on from the best chain that ends at most ``MAX_GAP`` words before
    it and not behind it in the template; overlaps count once.  A run that occurs more than
    once in the template comes with each of its places.
    """
    chains: list[list] = []  # start, end, place reached in the template, covered, continued, run, chain before
    low = 0
    for run in sorted(found):
        start, end, at, to = run
        while low < len(chains) and chains[low][1] < start - MAX_GAP - size:
            low += 1
        best = None
        for chain in chains[low:]:
            twice = max(0, chain[1] - start, chain[2] - at)
            gain = chain[3] + end - start - twice
            if start - chain[1] <= MAX_GAP and chain[2] <= to and twice < end - start and chain[0] < start:
                if best is None or gain > best[0]:
                    best = (gain, chain)
        if best is None:
            chains.append([start, end, to, end - start, 0, run, None])
        else:
            best[1][4] = 1
            chains.append([best[1][0], end, to, best[0], 0, run, best[1]])
    best_of: dict[int, list] = {}  # chains with one start are readings of one passage
    for chain in chains:
        start, end, _, covered, continued, _, _ = chain
        if not continued and (start not in best_of or (covered, -end) > (best_of[start][3], -best_of[start][1])):
            best_of[start] = chain
    for chain in best_of.values():
        runs, link = [], chain
        while link is not None:
            runs.append(link[5])
            link = link[6]
        yield chain[0], chain[1], chain[3], runs[::-1]


@functools.cache
def default_scanner() -> Scanner:
    return Scanner()


def scan_column(text: Column) -> Column:
    """The scan of every text as a struct; labels are sorted and joined by commas."""
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
    kind = pa.struct(
        [
            ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span)),
        ]
    )

    def row(text: str | None) -> dict:
        found = default_scanner().scan(text)
        spans = [{"label": a, "first": b, "end": c, "share": d} for a, b, c, d in found.spans]
        listed = {"base_labels": ",".join(sorted(found.base_labels)), "labels": ",".join(sorted(found.labels))}
        places = {"first_word": found.first_word, "last_word": found.last_word}
        return {"n_words": found.n_words, "n_base": found.n_base, "score": found.score, "spans": spans, **listed, **places}

    @F.arrow_udf(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first: long, end: long, share: double>>"
    )
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([row(t.as_py()) for t in batch], kind)

    return run(text)
