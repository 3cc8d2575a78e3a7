"""Licence scans: fixed phrases, and an exact containment join of text blocks with licence templates.

The templates are a stated query set; every block of every text is held against them.  The blocks
for a template T are all runs of ``|T| + |T| / 8`` successive words, over the whole text and across
line ends, so a notice is found however it is wrapped and its words have to stand together.  T is
found in a block B if |T and B| >= threshold * |T| over distinct words, and if B has the words that
tell T from its like (the version, "sa" of "by-sa").

The join is exact and works by filters.  Template words are ordered by their frequency in the
whole corpus (counted in a first pass; one number for each template word reaches the driver, a
bound that does not grow with the data).  A block can only meet the threshold if it holds one of
the template's rarest ``|T| - need + 1`` words (prefix), if the text has ``need`` words (length),
and if enough of the template's words that are not rarer stand around that word (position).
Survivors are verified.  Nothing is shuffled but the word counts.

Defined cases: a null or empty text has no words, no places and score 0; blocks of a template that
overlap are one find, at its best block; repeated rows are each scanned; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import alnum_words, slices

#: Phrases that give a label wherever their words stand consecutively.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Licence notices: label, text, and words that a block has to have.
TEMPLATES = (
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software without restriction", "permission granted"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "permission copies"),
    ("mit", "Released under the MIT License", "mit"),
    ("mit", "Licensed under the MIT License", "mit"),
    ("mit", "SPDX License Identifier MIT", "mit spdx"),
    ("apache-2", "Licensed under the Apache License Version 2.0 you may not use this file except in compliance with the License", "apache 2"),
    ("apache-2", "Licensed under the Apache License Version 2.0", "apache 2"),
    ("apache-2", "SPDX License Identifier Apache 2.0", "apache spdx"),
    ("gpl-3", "This work is licensed under the GNU General Public License version 3", "general 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation either version 3 of the License or at your option any later version", "general 3"),
    ("gpl-3", "SPDX License Identifier GPL 3.0", "gpl 3 spdx"),
    ("gpl-2", "This program is licensed under the GNU General Public License version 2", "general 2"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation either version 2 of the License or at your option any later version", "general 2"),
    ("gpl-2", "SPDX License Identifier GPL 2.0", "gpl 2 spdx"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License", "lesser"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation either version of the License or at your option any later version", "lesser"),
    ("agpl-3", "This program is licensed under the GNU Affero General Public License version 3", "affero"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation either version 3 of the License or at your option any later version", "affero"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution binary"),
    ("bsd", "Redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions retain"),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither endorse"),
    ("isc", "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission fee"),
    ("zlib", "This software is provided as is without any express or implied warranty In no event will the authors be held liable for any damages arising from the use of this software", "authors liable"),
    ("boost", "Distributed under the Boost Software License Version 1.0", "boost"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0", "mozilla 2"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "eclipse 2"),
    ("cddl", "The contents of this file are subject to the terms of the Common Development and Distribution License", "development distribution"),
    ("artistic-2", "This program is free software you can redistribute it under the terms of the Artistic License 2.0", "artistic 2"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License Version 1.1", "font sil"),
    ("wtfpl", "Do What The Fuck You Want To Public License", "want public"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "attribution"),
    ("cc-by", "Licensed under CC BY 4.0", "cc 4"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0", "nc"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "noncommercial"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0", "sa"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "sharealike"),
    ("cc-by-nd", "Licensed under CC BY ND 4.0", "nd"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License", "noderivatives"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered"),
    ("all-rights-reserved", "All rights reserved", "rights"),
)
THRESHOLD = 0.85


def block_words(template: list[bytes]) -> int:
    """The length of a template's blocks."""
    return len(template) + len(template) // 8


class Template:
    """A template's words as numbers in the corpus' frequency order, by place."""

    def __init__(self, label: str, words: list[bytes], required: list[bytes], threshold: float, rank: dict[bytes, int]):
        self.label, self.width = label, block_words(words)
        ordered = sorted({rank[w] for w in words})
        self.place = {r: k for k, r in enumerate(ordered)}
        self.size = len(ordered)
        self.need = max(1, math.ceil(threshold * self.size - 1e-9))
        self.prefix = ordered[: self.size - self.need + 1]
        self.required = frozenset(self.place[rank[w]] for w in required)

    def blocks(self, own: list[tuple[int, int]]) -> Iterator[tuple[int, float]]:
        """(first word, containment) of blocks that meet the threshold; ``own`` has (word number, place) of the template's words in a stretch."""
        count: Counter[int] = Counter()
        low = 0
        for at, place in own:
            count[place] += 1
            while at - own[low][0] >= self.width:
                count[own[low][1]] -= 1
                if not count[own[low][1]]:
                    del count[own[low][1]]
                low += 1
            if len(count) >= self.need and self.required <= count.keys():
                yield own[low][0], len(count) / self.size

    def finds(self, hits: list[tuple[int, int]], n_words: int) -> list[tuple[int, float]]:
        """(first word, containment) of the best of each run of overlapping blocks; ``hits`` has (word number, rank) of template words."""
        if n_words < self.need:  # length
            return []
        own = [(at, k) for at, r in hits if (k := self.place.get(r)) is not None]
        found: set[tuple[int, float]] = set()
        low = high = 0
        for at, place in own:
            while own[low][0] <= at - self.width:
                low += 1
            while high < len(own) and own[high][0] < at + self.width:
                high += 1
            # position: this is a prefix word, and enough words that are not rarer stand around it
            if place <= self.size - self.need and sum(k >= place for _, k in own[low:high]) >= self.need:
                found.update(self.blocks(own[low:high]))
        best: list[tuple[int, float]] = []
        ordered = sorted(found)
        for k, (at, share) in enumerate(ordered):
            if k and at < ordered[k - 1][0] + self.width:
                if share > best[-1][1]:
                    best[-1] = (at, share)
            else:
                best.append((at, share))
        return best


class Templates:
    """The templates, and an index of their prefixes."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...], threshold: float, frequency: dict[bytes, int]):
        vocabulary = sorted({w for _, t, _ in templates for w in alnum_words(t)}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: k for k, w in enumerate(vocabulary)}
        self.rows = [Template(label, alnum_words(t), alnum_words(r), threshold, self.rank) for label, t, r in templates]
        self.prefix: dict[int, list[int]] = {}
        for n, row in enumerate(self.rows):
            for r in row.prefix:
                self.prefix.setdefault(r, []).append(n)
        self.rare = frozenset(w for w, k in self.rank.items() if k in self.prefix)

    def found(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, first word, containment) of each find, in order."""
        if self.rare.isdisjoint(words):
            return []
        hits = [(at, r) for at, w in enumerate(words) if (r := self.rank.get(w)) is not None]
        candidates = {n for r in {r for _, r in hits} for n in self.prefix.get(r, ())}
        return sorted({(self.rows[n].label, at, share) for n in candidates for at, share in self.rows[n].finds(hits, len(words))}, key=lambda f: (f[1], f[0], -f[2]))


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(word number, label) of every place where a phrase's words stand."""
    line = b" %b " % b" ".join(words)
    out = []
    for phrase, label in phrases.items():
        raw = b" %b " % phrase.encode()
        at = line.find(raw)
        while at >= 0:
            out.append((line.count(b" ", 0, at), label))
            at = line.find(raw, at + 1)
    return sorted(out)


def word_frequency(docs: DataFrame, text: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often the corpus has each word of the vocabulary; one row for each comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in slices(batches):
            for value in batch.column(0).to_pylist():
                total.update(filter(vocabulary.__contains__, alnum_words(value)))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "word string, n bigint")
    return {r.word.encode(): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str, str], ...] = TEMPLATES, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, n_words, places (word, label) of phrases, and all finds (label, first word of the block, containment)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    phrases = PHRASES if phrases is None else phrases
    vocabulary = frozenset(w for _, t, _ in templates for w in alnum_words(t))
    index = Templates(templates, threshold, word_frequency(docs, text, vocabulary))
    place_t = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    find_t = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, places, finds = [], [], []
            for value in batch.column(1).to_pylist():
                words = alnum_words(value)
                counts.append(len(words))
                places.append([{"word": k, "label": x} for k, x in phrase_places(words, phrases)])
                finds.append([{"label": x, "word": at, "containment": share} for x, at, share in index.found(words)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(places, place_t), pa.array(finds, find_t)], names=["id", "n_words", "places", "finds"])

    frame = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    ddl = f"id {kind}, n_words bigint, places array<struct<word:bigint,label:string>>, finds array<struct<label:string,word:bigint,containment:double>>"
    return frame.mapInArrow(run, ddl).withColumnRenamed("id", doc_id)
