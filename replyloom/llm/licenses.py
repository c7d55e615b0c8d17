"""License scans by patience alignment.

Words unique to both a stretch of text and a template are anchors; the longest increasing
subsequence of their places keeps those in order, and the gaps between them are aligned the same
way in turn. A gap without such a word is aligned on its longest common run. Coverage is the
share of the template's words that are aligned.

Stretches are three templates long and start a template apart, over the whole text. A stretch
is aligned only if enough of the words that the template has once occur in it: with fewer, the
coverage asked for can't be reached, so nothing is missed.

Words are lower-cased (A-Z) with ASCII punctuation taken as space. Defined results: null and
empty texts hold no license; a license found several times in a text is one row per place;
repeated rows are scanned each; ties between stretches go to the earlier one; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows
from replyloom.llm.decontamination import tokens

COVERAGE = 0.8

# Wording of public licenses and license notices.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version."
    ),
}


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Places of aligned words of ``a`` and ``b``, in order."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = increasing(unique_pairs(a, a0, a1, b, b0, b1))
        if not anchors:
            run = SequenceMatcher(None, a, b, autojunk=False).find_longest_match(a0, a1, b0, b1)
            if not run.size:
                continue
            anchors = [(run.a + i, run.b + i) for i in range(run.size)]
        found += anchors
        for (left_a, left_b), (right_a, right_b) in zip(
            [(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True
        ):
            if left_a + 1 < right_a and left_b + 1 < right_b:
                todo.append((left_a + 1, right_a, left_b + 1, right_b))
    return sorted(found)


def unique_pairs(a: list, a0: int, a1: int, b: list, b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of the words that either range has once, in order of ``a``."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    at = {b[i]: i for i in range(b0, b1) if in_b[b[i]] == 1}
    return [(i, at[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in at]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that increases on both sides, by patience sorting."""
    tops: list[int] = []
    heads: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        if pile == len(tops):
            tops.append(y)
            heads.append(i)
        else:
            tops[pile], heads[pile] = y, i
        before[i] = heads[pile - 1] if pile else -1
    chain, i = [], heads[-1] if heads else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


class Scanner:
    """Templates and which words each has once."""

    def __init__(self, templates: dict[str, str], coverage: float):
        self.names = list(templates)
        self.templates = [tokens(t.encode()) for t in templates.values()]
        self.coverage = coverage
        self.once = [{w for w, n in Counter(t).items() if n == 1} for t in self.templates]
        # Words that may be missing can all be ones that the template has once.
        self.needed = [
            max(1, len(once) - math.floor((1 - coverage) * len(t) + 1e-9))
            for once, t in zip(self.once, self.templates, strict=True)
        ]
        vocabulary = sorted(set().union(*self.once))
        self.numbers = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.has = np.zeros((len(vocabulary) + 1, len(templates)), np.int32)
        for j, once in enumerate(self.once):
            self.has[[self.numbers[w] for w in once], j] = 1

    def scan(self, text: bytes | None) -> list[tuple]:
        """``(license, coverage, first word, last word)`` of each place."""
        words = tokens(text)
        known = self.numbers.get
        numbers = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
        distinct = np.unique(numbers)
        enough = self.has[distinct].sum(axis=0) >= self.needed
        rows = []
        for j in np.flatnonzero(enough).tolist():
            template, hits = self.templates[j], np.flatnonzero(self.has[numbers, j])
            n = len(template)
            starts = np.arange(0, max(1, len(words) - 2 * n), n)
            inside = np.searchsorted(hits, starts + 3 * n) - np.searchsorted(hits, starts)
            places: dict[int, tuple] = {}
            for start in starts[inside >= self.needed[j]].tolist():
                stretch = words[start : start + 3 * n]
                if len(self.once[j].intersection(stretch)) < self.needed[j]:
                    continue
                pairs = align(stretch, template)
                share = len(pairs) / n
                if share >= self.coverage:
                    row = (self.names[j], share, start + pairs[0][0], start + pairs[-1][0])
                    # Stretches overlap: of those that share a place the best alignment stays.
                    near = [k for k, p in places.items() if p[2] <= row[3] and row[2] <= p[3]]
                    if all(places[k][1] < share for k in near):
                        for k in near:
                            del places[k]
                        places[start] = row
            rows += places.values()
        return rows


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, license, coverage, first_word, last_word``: every place where a text holds a
    template."""
    scanner = Scanner(templates or TEMPLATES, coverage)
    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            for place in scanner.scan(row["text"]):
                yield row["key"], *place

    kind = dict(docs.dtypes)[key]
    return map_rows(
        chosen, run, f"`{key}` {kind}, license string, coverage double, first_word bigint, last_word bigint"
    )
