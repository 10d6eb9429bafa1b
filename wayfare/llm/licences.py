"""Licence scans with a generalised suffix automaton.

The word sequences of all licence templates are put into one automaton. A file is streamed through
it once and yields matching statistics: for every word, the longest run ending there that some
template holds. Long runs are chained, in order, into covered spans of a template.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tables import columns, in_slices

#: Words of the UTF-8 bytes after A-Z are lower-cased; bytes from 0x80 on belong to words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Runs of fewer words are left to chance.
LEAST_RUN = 4
#: Most words of the file, and of the template, that two runs of one chain may lie apart.
MOST_GAP = 40
#: Share of a template's words that a chain covers to make a label.
LEAST_COVERED = 0.7

# Phrases whose places are counted, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Notices and passages of public licences, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This software is licensed under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The"
        " above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
        " the specific language governing permissions and limitations under the License.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
)

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<label:string,template:int,first_word:long,last_word:long,covered:double>>"
)


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased words; a null text has none."""
    return WORD.findall((text or "").encode("utf-8", "replace").lower())


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; states of one are those of all.

    ``ends`` keeps where a state's words first end: (template, position). It grows with the
    templates alone, at most two states a word, and is what is sent to the tasks.
    """

    steps: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    longest: list[int] = field(default_factory=lambda: [0])
    links: list[int] = field(default_factory=lambda: [-1])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])
    lengths: list[int] = field(default_factory=list)

    def _state(self, longest: int, steps: dict[bytes, int], link: int) -> int:
        self.steps.append(steps)
        self.longest.append(longest)
        self.links.append(link)
        self.ends.append(set())
        return len(self.steps) - 1

    def _split(self, last: int, word: bytes, to: int) -> int:
        """The part of state ``to`` that holds only words read after ``last``."""
        clone = self._state(self.longest[last] + 1, dict(self.steps[to]), self.links[to])
        self.links[to] = clone
        while last >= 0 and self.steps[last].get(word) == to:
            self.steps[last][word] = clone
            last = self.links[last]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if (to := self.steps[last].get(word)) is not None:
            return to if self.longest[to] == self.longest[last] + 1 else self._split(last, word, to)
        new = self._state(self.longest[last] + 1, {}, 0)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.links[last]
        if last >= 0:
            to = self.steps[last][word]
            self.links[new] = to if self.longest[to] == self.longest[last] + 1 else self._split(last, word, to)
        return new

    def add(self, sequence: list[bytes]) -> None:
        template, state, path = len(self.lengths), 0, []
        for word in sequence:
            state = self._extend(state, word)
            path.append(state)
        self.lengths.append(len(sequence))
        # States may have been split later on, so the places are walked once more.
        state = 0
        for at, word in enumerate(sequence):
            state = self.steps[state][word]
            self.ends[state].add((template, at))

    def close(self) -> Automaton:
        """Places of a state also are places of the shorter words it links to."""
        for state in sorted(range(1, len(self.steps)), key=lambda s: -self.longest[s]):
            if self.links[state] > 0:
                self.ends[self.links[state]] |= self.ends[state]
        return self

    def statistics(self, sequence: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, length, state) of matches that the next word does not prolong."""
        state = length = 0
        for at, word in enumerate(sequence):
            to = self.steps[state].get(word)
            if to is not None:
                state, length = to, length + 1
                continue
            if length:
                yield at - 1, length, state
            while state > 0 and word not in self.steps[state]:
                state = self.links[state]
            to = self.steps[state].get(word)
            length = self.longest[state] + 1 if to is not None else 0
            state = to if to is not None else 0
        if length:
            yield len(sequence) - 1, length, state


def chains(automaton: Automaton, sequence: list[bytes]) -> list[tuple[int, int, int, float]]:
    """(template, first word, last word, covered share) of chained runs, best of each chain.

    Runs of one template are chained when they follow each other in the file and in the template,
    at most ``MOST_GAP`` words apart in both. A run may stand at several places of a template; each
    place is a link of its own. Covered words count once.
    """
    open_: dict[int, list[list[int]]] = {}  # template -> chains: first, last, template end, covered
    done: list[tuple[int, int, int, float]] = []

    def finish(template: int, chain: list[int]) -> None:
        done.append((template, chain[0], chain[1], chain[3] / automaton.lengths[template]))

    for at, length, state in automaton.statistics(sequence):
        if length < LEAST_RUN:
            continue
        begin = at - length + 1
        for template, end in sorted(automaton.ends[state]):
            live = []
            best: list[int] | None = None
            for chain in open_.get(template, ()):
                if begin - chain[1] > MOST_GAP:
                    finish(template, chain)
                    continue
                live.append(chain)
                # What runs over the end of the chain, in the file or in the template, counts once.
                fresh = min(length, at - chain[1], end - chain[2])
                if fresh > 0 and end - length + 1 - chain[2] <= MOST_GAP and (best is None or chain[3] + fresh > best[3]):
                    best = [chain[0], at, end, chain[3] + fresh]
            live.append(best if best and best[3] > length else [begin, at, end, length])
            # Chains that end at one place of the template go on alike: the best of them stays, and one
            # that stands elsewhere in the file is done.
            top: dict[int, list[int]] = {}
            for chain in live:
                other = top.setdefault(chain[2], chain)
                if other is chain:
                    continue
                better, worse = (chain, other) if (chain[3], chain[1]) > (other[3], other[1]) else (other, chain)
                top[chain[2]] = better
                if worse[1] < better[0] or better[1] < worse[0]:
                    finish(template, worse)
            open_[template] = list(top.values())
    for template, live in open_.items():
        for chain in live:
            finish(template, chain)
    return done


def automaton_of(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> Automaton:
    automaton = Automaton()
    for _, text in templates:
        automaton.add(words(text))
    return automaton.close()


def phrase_places(sequence: list[bytes], joined: bytes, phrase: bytes) -> list[int]:
    """Word positions where the words of ``phrase`` stand in a row; ``joined`` is `` w w w ``."""
    places, at = [], joined.find(phrase)
    while at >= 0:
        places.append(at)
        at = joined.find(phrase, at + 1)
    out, counted, count = [], 0, 0
    for at in places:
        count += joined.count(b" ", counted, at)
        counted = at
        out.append(count)
    return out


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Licences of every row of ``docs`` (doc_id, text), over whole texts.

    n_base, first_word, last_word and base_labels are about ``phrases``; ``spans`` are the chains
    that cover ``LEAST_COVERED`` of a template, in order and without overlap; ``labels`` joins both
    kinds. ``score`` is the highest covered share, 1 where a phrase stands. A null or empty text has
    no words, no labels (empty strings), null positions and score 0. Repeated rows give repeated
    results; a null doc_id stays null.
    """
    looked = [(b" " + b" ".join(words(text)) + b" ", label) for text, label in phrases]
    labels = [label for label, _ in templates]
    automaton = automaton_of(templates)

    def one(text: str | None) -> tuple:
        found = words(text)
        joined = b" " + b" ".join(found) + b" "
        places: list[int] = []
        base = set()
        for phrase, label in looked:
            if phrase in joined:
                base.add(label)
                places += phrase_places(found, joined, phrase)
        score = 1.0 if base else 0.0
        spans: list[dict] = []
        taken: list[tuple[int, int]] = []  # first and last words of the spans, in order
        # Templates share sentences: where spans overlap, the one with most covered words stands.
        found_chains = chains(automaton, found)
        for template, first, last, covered in sorted(found_chains, key=lambda c: (-c[3] * automaton.lengths[c[0]], -c[3], c)):
            score = max(score, min(1.0, covered))
            place = bisect_right(taken, (last, len(found)))
            if covered >= LEAST_COVERED and not (place and taken[place - 1][1] >= first):
                taken.insert(place, (first, last))
                spans.append({"label": labels[template], "template": template, "first_word": first, "last_word": last, "covered": min(1.0, covered)})
        spans.sort(key=lambda s: s["first_word"])
        every = base | {s["label"] for s in spans}
        ends = (min(places), max(places)) if places else (None, None)
        return len(found), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(every)), score, spans

    span = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), span)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 512):
            rows = [one(text.as_py()) for text in batch.column("text")]
            values = list(map(list, zip(*rows))) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(values, kinds))], names)

    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, RESULT)
