"""Licence scans by matching statistics over a suffix automaton of licence texts.

The automaton holds every run of words of all templates. A file streams through it word by
word; after each word the automaton knows the longest run ending there that stands in some
template. Runs that can't be extended are matches; matches of one template that follow each
other in both texts are chained, and a chain that covers enough of the template is a span.
Phrases are found on the way: a phrase ends where the run at hand ends with it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that give a label wherever they stand, and the beginnings or notices of well-known licences.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
               "the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
               "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
# Words of a match that a chain may use, words between two matches of a chain, share of a template that a span covers.
MIN_RUN = 3
MAX_GAP = 20
COVERAGE = 0.8
# A base label without a covered template has this score.
PHRASE_SCORE = 0.5
# Bytes of a text that are split into words at once.
CHUNK = 1 << 20
_KEPT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
SPANS = "array<struct<template: int, label: string, first_word: long, last_word: long, covered: int, coverage: double>>"
FIELDS = f"n_words long, n_base long, first_word long, last_word long, base_labels array<string>, spans {SPANS}"


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII bytes; A to Z are lower-cased."""
    return text.translate(_KEPT).split()


def word_chunks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``CHUNK`` bytes at a time."""
    clean, at = text.translate(_KEPT), 0
    while at < len(clean):
        end = clean.find(b" ", at + CHUNK)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


class Automaton:
    """Suffix automaton of several word sequences, with the places in the templates where each state's runs end."""

    def __init__(self, templates: list[list[bytes]], phrases: list[list[bytes]]):
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate(templates):
            self._add(sequence, t)
        for sequence in phrases:
            self._add(sequence, None)
        order = sorted(range(1, len(self.length)), key=lambda s: -self.length[s])
        for s in order:
            self.ends[self.link[s]] |= self.ends[s]
        # Phrases a state ends with: its own longest and those of the states its links lead to.
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.length]
        for p, sequence in enumerate(phrases):
            state = 0
            for word in sequence:
                state = self.next[state][self.words[word]]
            self.phrases[state].append((p, len(sequence)))
        for s in reversed(order):
            self.phrases[s] = self.phrases[s] + self.phrases[self.link[s]]

    def _add(self, sequence: list[bytes], template: int | None) -> None:
        last = 0
        for place, word in enumerate(sequence):
            last = self._extend(last, self.words.setdefault(word, len(self.words)))
            if template is not None:
                self.ends[last].add((template, place))

    def _state(self, length: int, transitions: dict[int, int], link: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of the runs ``p`` + ``word`` if ``q`` also stands for longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def runs(self, chunks: Iterator[list[bytes]]) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """For each chunk its number of words, and ``place, state, run`` of every word that stands in a template.

        A run is 0 where a word of no template precedes, so only words of templates are visited.
        """
        state, run, at = 0, 0, 0
        known, link, length, following = self.words.get, self.link, self.length, self.next
        for words in chunks:
            ids = np.array([known(w, -1) for w in words], np.int64)
            found = []
            before = at - 1 if run else -2
            for i in np.flatnonzero(ids >= 0).tolist():
                if at + i != before + 1:
                    state, run = 0, 0
                word = int(ids[i])
                while word not in following[state]:
                    state = link[state]
                    run = length[state]
                state, run, before = following[state][word], run + 1, at + i
                found.append((before, state, run))
            at += len(words)
            if before != at - 1:
                state, run = 0, 0
            yield len(words), found


@dataclass
class Chain:
    first: int
    last: int
    place: int
    covered: int


class Scanner:
    """Scans texts against templates and phrases; one for each task."""

    def __init__(self, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES, min_run: int = MIN_RUN, max_gap: int = MAX_GAP,
                 coverage: float = COVERAGE):
        self.labels = [label for label, _ in templates]
        sequences = [words_of(text.encode()) for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        self.phrase_labels = list(phrases.values())
        self.automaton = Automaton(sequences, [words_of(p.encode()) for p in phrases])
        self.min_run, self.max_gap, self.coverage = min_run, max_gap, coverage

    def scan(self, text: str | None) -> tuple:
        """``n_words, n_base, first_word, last_word, base_labels, spans`` of one text."""
        total, starts_n, first, last, labels = 0, 0, None, None, set()
        chains: list[list[Chain]] = [[] for _ in self.sizes]
        spans: list[list[Chain]] = [[] for _ in self.sizes]
        held: tuple[int, int, int] | None = None
        phrases, min_run = self.automaton.phrases, self.min_run
        for count, found in self.automaton.runs(word_chunks((text or "").encode())):
            total += count
            for place, state, run in found:
                for p, size in phrases[state]:
                    if size <= run:
                        start = place - size + 1
                        starts_n += 1
                        labels.add(self.phrase_labels[p])
                        first = start if first is None else min(first, start)
                        last = start if last is None else max(last, start)
                # A run that the next word doesn't extend is a match.
                if held is not None and (place != held[0] + 1 or run != held[2] + 1):
                    self._match(held, chains, spans)
                held = (place, state, run) if run >= min_run else None
        if held is not None:
            self._match(held, chains, spans)
        for t in range(len(chains)):
            self._close(t, chains[t], spans)
        found = [{"template": t, "label": self.labels[t], "first_word": c.first, "last_word": c.last, "covered": c.covered,
                  "coverage": c.covered / self.sizes[t]} for t, kept in enumerate(spans) for c in kept]
        found.sort(key=lambda s: (s["first_word"], s["last_word"], s["template"]))
        return total, starts_n, first, last, sorted(labels), found

    def _match(self, match: tuple[int, int, int], chains: list[list[Chain]], spans: list[list[Chain]]) -> None:
        """Extend the chains of every template that the match stands in."""
        place, state, run = match
        for t, end in sorted(self.automaton.ends[state]):
            near = [c for c in chains[t] if place - c.last <= self.max_gap + run]
            if len(near) < len(chains[t]):
                self._close(t, [c for c in chains[t] if place - c.last > self.max_gap + run], spans)
            best = Chain(place - run + 1, place, end, run)
            for c in near:
                # Words that overlap the chain in the text or in the template count once.
                new = run - max(0, c.last - (place - run), c.place - (end - run))
                if c.place < end and 0 < new and c.covered + new > best.covered:
                    best = Chain(c.first, place, end, c.covered + new)
            near = [c for c in near if c.place != end or c.covered > best.covered]
            chains[t] = [*near, best]

    def _close(self, t: int, chains: list[Chain], spans: list[list[Chain]]) -> None:
        """Keep the chains that cover enough; of two that overlap the one that covers more, the earlier one of equals."""
        for c in sorted(chains, key=lambda c: (c.last, -c.covered, c.first)):
            if c.covered < self.coverage * self.sizes[t]:
                continue
            if not spans[t] or c.first > spans[t][-1].last:
                spans[t].append(c)
            elif c.covered > spans[t][-1].covered:
                spans[t][-1] = c


def scan_licenses(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, spans, labels, score``.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the least
    and largest word at which one starts, null without any. ``spans`` are the stretches of words
    that cover ``coverage`` of a template by runs of ``min_run`` words or more in the template's
    order, with at most ``max_gap`` other words between two runs. ``labels`` joins the phrases'
    and the spans' labels, different and sorted. ``score`` is the largest coverage of a span,
    0.5 at least where a phrase stands, else 0. A null text is empty and has no words; a very
    long one is split piece by piece and holds only chains that can still grow. Repeated rows
    give repeated rows, an empty table an empty result; other columns aren't read.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**options)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([
            ("template", pa.int32()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("covered", pa.int32()), ("coverage", pa.float64())])))
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "spans"]
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names)
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, f"doc_id {kind}, {FIELDS}")
    covered = F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))
    return found.withColumns({
        "labels": F.array_sort(F.array_union("base_labels", F.transform("spans", lambda s: s["label"]))),
        "score": F.greatest(covered, F.when(F.col("n_base") > 0, PHRASE_SCORE).otherwise(0.0))})
