"""License scans by patience alignment of texts with license templates.

A template is a list of words (letters and digits, lower case).  For a text:

1. words of the whole text are hashed; a template whose words, counted with their
   repeats, are not found often enough to reach ``min_coverage`` is put aside (it can't);
2. a window a little larger than the template slides over the places of all its words;
   where the words inside, counted with their repeats, can reach ``min_coverage``, it is aligned;
3. patience alignment of window (whole, and cut to the template's length) and template: words that are unique to both are
   anchors, the longest increasing subsequence of them is kept, and the gaps between
   anchors are aligned the same way, after their equal ends are matched;
4. coverage is the aligned share of the template's words.  The words that tell a license from
   its neighbours (name, version, NC, SA, ND: ``DECIDING``) must be among the aligned ones.  Where
   notices overlap, the one with the best fit stays: aligned words by all words of template and span.

The templates are notices and opening grants; whole license texts are found by these.  A
license that no template names gives nothing, or its family where one is listed (Apache, BSD).

Null or empty texts hold nothing.  Texts of any length are read whole.  A license has one
row a text: its best notice (the first of equal ones) and the number of notices that stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import PUNCTUATION_BYTES, word_hashes

MIN_COVERAGE = 0.8
FOUND = "array<struct<license:string,coverage:double,first_word:long,n_words:long,notices:long>>"
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

# Notices and opening grants of public licenses, by license and wording.
TEMPLATES: list[tuple[str, str]] = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation; either version 2 of the "
     "License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
     "and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache", "Released under the Apache License."),
    ("BSD", "Released under the BSD License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
     "Public License 2.0"),
]
GNU_SHORT = "This work is licensed under the GNU {} General Public License, version {}."
GNU_LONG = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
            "General Public License as published by the Free Software Foundation, either version {} of the License, "
            "or (at your option) any later version.")
GNU_FAMILIES = [("LGPL-3.0", "Lesser", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("AGPL-3.0", "Affero", "3")]
CC_SHORT = "Licensed under CC {} {}."
CC_LONG = "This work is licensed under a Creative Commons {} {} {} License."
CC_ELEMENTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_LICENSES = ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"3.0": "Unported", "4.0": "International"}

#: Words that tell a license from its neighbours: those that a template holds must be aligned.
DECIDING: dict[str, tuple[str, ...]] = {
    "GPL-3.0": ("general", "public", "3"),
    "GPL-2.0": ("general", "public", "2"),
    "MIT": ("mit",),
    "Apache-2.0": ("apache", "2"),
    "Apache": ("apache",),
    "BSD": ("bsd",),
    "Unlicense": ("unencumbered",),
    "CC0-1.0": ("waived",),
    "EPL-2.0": ("eclipse", "2"),
    "MPL-2.0": ("mozilla", "2"),
}

for _name, _kind, _version in GNU_FAMILIES:
    TEMPLATES += [(_name, t.format(_kind, _version)) for t in (GNU_SHORT, GNU_LONG)]
    DECIDING[_name] = (_kind.lower(), "public", *_version.split("."))
for _code in CC_LICENSES:
    for _version, _region in CC_VERSIONS.items():
        _elements = [CC_ELEMENTS[e] for e in _code.split("-")]
        _name = f"CC-{_code}-{_version}"
        TEMPLATES += [(_name, CC_SHORT.format(_code, _version)),
                      (_name, CC_LONG.format("-".join(_elements), _version, _region))]
        DECIDING[_name] = ("cc", "creative", *_code.lower().split("-"), *(e.lower() for e in _elements),
                           _version[0])


def spelled(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


# --- patience alignment ------------------------------------------------------

def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (a, b), ascending in a, whose b rise (patience piles)."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        tops[pile:pile + 1] = [b]
        last[pile:pile + 1] = [k]
        back.append(last[pile - 1] if pile else -1)
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions of two word lists by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = rising([(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place])
        if not anchors:
            continue
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        out += anchors
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]) if p + 1 < r and q + 1 < s]
    return sorted(out)


# --- scanning ----------------------------------------------------------------

@dataclass
class Template:
    license: str
    words: list[bytes]
    hashes: np.ndarray            # distinct word hashes, ascending
    counts: np.ndarray            # their repeats in the template
    deciding: list[int]           # places of the words that must be aligned


def templates(pairs: list[tuple[str, str]] = TEMPLATES) -> list[Template]:
    out = []
    for name, text in pairs:
        words = spelled(text)
        hashes, counts = np.unique(word_hashes([b" ".join(words)])[0], return_counts=True)
        must = {w.encode() for w in DECIDING.get(name, ())}
        out.append(Template(name, words, hashes, counts, [k for k, w in enumerate(words) if w in must]))
    return out


def scan(text: str, hashed: np.ndarray, known: list[Template], vocabulary: np.ndarray,
         min_coverage: float) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, first word, words spanned, notices) of each license found: its
    best notice, and how many stand apart from each other in the text."""
    at = np.searchsorted(vocabulary, hashed)
    at[at == len(vocabulary)] = 0
    hits = np.flatnonzero(vocabulary[at] == hashed)
    if not len(hits):
        return []
    present, there = np.unique(hashed[hits], return_counts=True)
    words: list[bytes] | None = None
    found: set[tuple[float, int, int, str, float]] = set()
    for t in known:
        k = np.searchsorted(present, t.hashes)
        k[k == len(present)] = 0
        held = np.where(present[k] == t.hashes, there[k], 0)
        size = len(t.words)
        if np.minimum(held, t.counts).sum() < min_coverage * size:
            continue
        words = words if words is not None else spelled(text)
        slack = max(3, size // 4)
        for start, end in _windows(hits, hashed[hits], t, size + 2 * slack, min_coverage * size):
            notice = fitted(words, start, end, t, min_coverage)
            if notice:
                found.add(notice)
    return _licenses(_apart(found))


def fitted(words: list[bytes], start: int, end: int, t: Template,
           min_coverage: float) -> tuple[float, int, int, str, float] | None:
    """(-fit, -words spanned, first word, license, coverage) of the notice in a window, if the
    template is covered and all its deciding words are aligned.  The window is aligned whole and cut to
    the template's own length, where words of the next notice can't draw the alignment out; the best fit counts."""
    best = None
    for stop in {min(end, start + len(t.words)), end}:
        pairs = align(words[start:stop], t.words)
        coverage = len(pairs) / len(t.words)
        if coverage < min_coverage or not {b for _, b in pairs}.issuperset(t.deciding):
            continue
        first, last = start + pairs[0][0], start + pairs[-1][0]
        n = last - first + 1
        notice = -len(pairs) / (len(t.words) + n - len(pairs)), -n, first, t.license, coverage
        best = notice if best is None else min(best, notice)
    return best


def _windows(places: np.ndarray, words: np.ndarray, t: Template, width: int, need: float) -> Iterator[tuple[int, int]]:
    """Windows of ``width`` words from each place of a template word, in which the template's
    words, each at most as often as in the template, are ``need`` or more."""
    k = np.searchsorted(t.hashes, words)
    k[k == len(t.hashes)] = 0
    own = t.hashes[k] == words
    at, k = places[own], k[own]
    ends = np.searchsorted(at, at + width)
    if not (ends - np.arange(len(at)) >= need).any():
        return
    room, inside, right = t.counts.tolist(), 0, 0
    at, k = at.tolist(), k.tolist()
    for left, end in enumerate(ends.tolist()):
        while right < end:
            room[k[right]] -= 1
            inside += room[k[right]] >= 0
            right += 1
        if inside >= need:
            yield at[left], at[left] + width
        inside -= room[k[left]] >= 0
        room[k[left]] += 1


def _apart(found: set[tuple[float, int, int, str, float]]) -> list[tuple[float, int, int, str, float]]:
    """Of notices at overlapping places only the best fit stays: words that the
    template lacks inside the span count against it."""
    out: list[tuple[float, int, int, str, float]] = []
    taken: list[tuple[int, int]] = []                   # spans that stay, ascending
    for notice in sorted(found):
        first, end = notice[2], notice[2] - notice[1]
        k = bisect_left(taken, (first, end))
        if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or taken[k][0] >= end):
            taken.insert(k, (first, end))
            out.append(notice)
    return out


def _licenses(notices: list[tuple[float, int, int, str, float]]) -> list[tuple[str, float, int, int, int]]:
    """The best notice of each license (the first of equal ones), by place."""
    number = Counter(name for *_, name, _ in notices)
    best: dict[str, tuple[str, float, int, int, int]] = {}
    for _, n, first, name, coverage in notices:
        best.setdefault(name, (name, coverage, first, -n, number[name]))
    return sorted(best.values(), key=lambda x: x[2])


def with_licenses(docs: DataFrame, text_col: str = "text", into: str = "licenses",
                  min_coverage: float = MIN_COVERAGE, pairs: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Add ``into``: licenses found in each text, in the order of their places."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = templates(pairs)
        vocabulary = np.unique(np.concatenate([t.hashes for t in known]))
        for texts in batches:
            values, out = texts.tolist(), []
            for at in range(0, len(values), 512):
                some = values[at:at + 512]
                hashed = word_hashes([(t or "").encode().lower() for t in some], PUNCTUATION_BYTES)
                out += [[dict(zip(("license", "coverage", "first_word", "n_words", "notices"), x))
                         for x in scan(t, h, known, vocabulary, min_coverage)] if len(h) else []
                        for t, h in zip(some, hashed)]
            yield pd.Series(out, dtype=object)

    columns = [c for c in docs.columns if c != into]
    return docs.select(*columns, F.pandas_udf(run, FOUND)(F.col(text_col)).alias(into))
