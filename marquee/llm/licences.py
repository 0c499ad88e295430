"""Licence texts inside documents, found by matching statistics against one suffix automaton of all templates.

The automaton holds every run of words of every template. A document is streamed through it once; each place gets the length
of the longest run ending there that some template has. Long runs that follow each other in the document and in a template
are chained into one span, and the share of the template that a chain covers decides on the label.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.base import arrow, named, texts
from marquee.llm.words import Words, groups

# Phrases that always give their label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Well-known notices, as (label, text). Only their words count.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "mit",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http www apache org licenses LICENSE 2 0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
]

#: Words of the shortest run that counts, and of the widest gap that a chain passes.
LEAST_RUN = 4
GAP = 12
#: A chain gives its template's label if it covers this share of it, or this many words.
SHARE = 0.6
MANY = 40

_BREAKS = np.ones(256, bool)
_BREAKS[48:58] = _BREAKS[97:123] = _BREAKS[128:] = False


class Automaton:
    """A suffix automaton of several sequences. For each state: the longest run, the link to its longest suffix state, the
    steps, and for each template in which its runs occur the place after one of them."""

    def __init__(self, sequences: list[list[int]]):
        self.longest, self.link, self.step, self.places = [0], [-1], [{}], [{}]
        for template, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._add(last, word)
                self.places[last].setdefault(template, place + 1)
        for state in sorted(range(1, len(self.longest)), key=self.longest.__getitem__, reverse=True):
            if self.link[state] > 0:
                up = self.places[self.link[state]]
                for template, place in self.places[state].items():
                    up[template] = min(place, up.get(template, place))

    def _new(self, longest: int, link: int, step: dict) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.step.append(step)
        self.places.append({})
        return len(self.longest) - 1

    def _split(self, before: int, state: int, word: int) -> int:
        """The state for the runs up to `longest[before] + 1` that `state` shares with longer ones."""
        if self.longest[state] == self.longest[before] + 1:
            return state
        clone = self._new(self.longest[before] + 1, self.link[state], dict(self.step[state]))
        self.link[state] = clone
        while before >= 0 and self.step[before].get(word) == state:
            self.step[before][word] = clone
            before = self.link[before]
        return clone

    def _add(self, last: int, word: int) -> int:
        if word in self.step[last]:  # an earlier sequence has this run
            return self._split(last, self.step[last][word], word)
        state, before = self._new(self.longest[last] + 1, 0, {}), last
        while before >= 0 and word not in self.step[before]:
            self.step[before][word] = state
            before = self.link[before]
        if before >= 0:
            self.link[state] = self._split(before, self.step[before][word], word)
        return state

    def matches(self, sequence: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of the runs that cannot be made longer to the right, of `least` words or more."""
        out, state, length = [], 0, 0
        for place, word in enumerate(sequence):
            if word not in self.step[state]:
                if length >= least:
                    out.append((place, length, state))
                while state > 0 and word not in self.step[state]:
                    state = self.link[state]
                    length = self.longest[state]
            if word in self.step[state]:
                state, length = self.step[state][word], length + 1
            else:
                state, length = 0, 0
        if length >= least:
            out.append((len(sequence), length, state))
        return out


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        split = lambda s: Words([s.encode()], lower=True, space=_BREAKS)
        sequences = [split(t) for _, t in templates]
        phrase_words = [split(p) for p in phrases]
        hashes = [w.hashes() for w in sequences + phrase_words]
        self.vocabulary = np.unique(np.concatenate(hashes))
        ids = [np.searchsorted(self.vocabulary, h) for h in hashes]
        self.labels = [label for label, _ in templates]
        self.lengths = [len(i) for i in ids[: len(templates)]]
        self.automaton = Automaton([i.tolist() for i in ids[: len(templates)]])
        self.phrases = [(i, label) for i, label in zip(ids[len(templates) :], phrases.values())]

    def ids(self, words: Words) -> np.ndarray:
        """Places in the vocabulary, -1 for other words."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, -1)

    def chains(self, sequence: np.ndarray, offset: int) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, words spanned, words covered, share of the template) of the chains in some words."""
        by_template: dict[int, list[list[int]]] = {}
        for end, length, state in self.automaton.matches(sequence.tolist(), LEAST_RUN):
            for template, place in self.automaton.places[state].items():
                chain = by_template.setdefault(template, [])
                begin, t_begin = end - length, place - length
                if chain and 0 <= begin - chain[-1][1] <= GAP and 0 <= t_begin - chain[-1][2] <= GAP:
                    chain[-1][1], chain[-1][2] = end, place
                    chain[-1][3] += length
                else:
                    chain.append([begin, end, place, length])
        out = []
        for template, chain in by_template.items():
            for begin, end, _, covered in chain:
                share = min(1.0, covered / self.lengths[template])
                if share >= SHARE or covered >= MANY:
                    out.append((self.labels[template], offset + begin, end - begin, covered, share))
        return sorted(out, key=lambda x: (x[1], x[0], -x[3], -x[4]))

    def scan(self, raw: list[bytes]):
        """For each text: words, places of phrases, first and last of them, base labels, chains."""
        for a, b in groups(raw):
            words = Words(raw[a:b], lower=True, space=_BREAKS)
            ids, first = self.ids(words), words.first
            hits: list[list[tuple[int, str]]] = [[] for _ in range(b - a)]
            for phrase, label in self.phrases:
                k = len(phrase)
                if len(ids) >= k:
                    there = np.ones(len(ids) - k + 1, bool)
                    for j, w in enumerate(phrase.tolist()):
                        there &= ids[j : len(ids) - k + 1 + j] == w
                    for p in np.flatnonzero(there).tolist():
                        own = int(np.searchsorted(first, p, "right")) - 1
                        if p + k <= first[own + 1]:
                            hits[own].append((p - int(first[own]), label))
            # runs of vocabulary words, cut at the ends of texts
            known = ids >= 0
            edge = np.zeros(len(ids) + 1, bool)
            edge[first] = True
            begin = np.flatnonzero(known & (np.append(True, ~known[:-1]) | edge[:-1])) if len(ids) else []
            stop = np.flatnonzero(known & (np.append(~known[1:], True) | edge[1:])) + 1 if len(ids) else []
            spans: list[list] = [[] for _ in range(b - a)]
            pending: dict[int, list[tuple[int, int]]] = {}
            for x, y in zip(begin, stop):
                if y - x >= LEAST_RUN:
                    own = int(np.searchsorted(first, x, "right")) - 1
                    runs = pending.setdefault(own, [])
                    if runs and x - runs[-1][1] <= GAP:
                        runs[-1] = (runs[-1][0], int(y))
                    else:
                        runs.append((int(x), int(y)))
            for own, runs in pending.items():
                for x, y in runs:
                    spans[own].extend(self.chains(ids[x:y], x - int(first[own])))
            for i in range(b - a):
                yield int(first[i + 1] - first[i]), hits[i], spans[i]


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))


def _scan(batches):
    scanner = _scanner()
    for batch in batches:
        rows = []
        for n, hits, spans in scanner.scan([t or b"" for t in texts(batch.column(1))]):
            basic = {label for _, label in hits}
            at = [p for p, _ in hits]
            rows.append(
                {
                    "n_words": n,
                    "n_base": len(hits),
                    "first_word": min(at, default=None),
                    "last_word": max(at, default=None),
                    "base_labels": ",".join(sorted(basic)),
                    "labels": ",".join(sorted(basic | {s[0] for s in spans})),
                    "score": 1.0 if hits else max((s[4] for s in spans), default=0.0),
                    "spans": [dict(zip(("label", "first_word", "words", "covered", "share"), s)) for s in spans],
                }
            )
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": _SPANS}
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in kinds.items())], ["doc_id", *kinds])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Phrases and template spans of every text; one row per row of `docs`.

    A null text counts as empty: no words, no labels (''), null places, score 0. `score` is 1 where a phrase stands, else the
    largest share of a template that a chain covers. Repeated rows and null ids are kept, other columns are not read. One
    map over the rows; the automaton is made in each worker from the fixed templates.
    """
    rows = named(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,words:long,covered:long,share:double>>"
    return arrow(rows, _scan, schema)
