"""License scans by patience alignment.

A text is aligned with a license template by anchors: words that are unique both to the text and to
the template, of which the longest increasing subsequence is kept.  The gaps between anchors, ends
included, are aligned in the same way, after what their ends have in common; a gap without anchors is
aligned by a longest common subsequence.  Texts are aligned by windows that begin at a word of the
template, so that a notice is found as often as it stands there.  The share of the template's words
that find a place close together in the text is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import map_rows

WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
#: Public license notices and the openings of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience piles with back-pointers."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(k)
        else:
            tops[pile], at[pile] = v, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def _unique(words: list[str], lo: int, hi: int, wanted: set[str]) -> dict[str, int]:
    """Places of the ``wanted`` words that stand once in this part."""
    once: dict[str, int] = {}
    twice = set()
    for k in range(lo, hi):
        w = words[k]
        if w in wanted:
            if w in once:
                twice.add(w)
            once[w] = k
    return {w: k for w, k in once.items() if w not in twice}


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs (i, j), increasing in both, of equal words of ``a`` and ``b``, by patience."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            pairs.append((k, m))
        if i >= k or j >= m:
            continue
        own = _unique(b, j, m, set(b[j:m]))
        there = _unique(a, i, k, set(own))
        both = sorted((p, own[w]) for w, p in there.items())
        if not both:
            # No word is unique to both: patience over all pairs of equal words, the later of ``b`` first.
            places: dict[str, list[int]] = {}
            for q in range(m - 1, j - 1, -1):
                places.setdefault(b[q], []).append(q)
            every = [(p, q) for p in range(i, k) for q in places.get(a[p], ())]
            pairs += [every[x] for x in increasing([q for _, q in every])]
            continue
        anchors = [both[x] for x in increasing([q for _, q in both])]
        pairs += anchors
        edges = [(i - 1, j - 1), *anchors, (k, m)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(pairs)


class Scanner:
    """Finds templates in texts: ``coverage`` of a template's words within ``stretch`` times its length."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8, stretch: float = 2.0) -> None:
        self.coverage, self.stretch = coverage, stretch
        self.templates = {name: words_of(t) for name, t in templates.items()}
        self.counts = {name: Counter(w) for name, w in self.templates.items()}
        self.wanted = frozenset(w for t in self.templates.values() for w in t)

    def __call__(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, end) of all places that are covered, in words of the text; best first.

        Places of one template do not overlap.
        """
        words = words_of(text or "")
        have = Counter(filter(self.wanted.__contains__, words))
        found = []
        for name, template in self.templates.items():
            need = self.coverage * len(template)
            # No alignment matches more words than both have in common.
            if sum(min(n, have[w]) for w, n in self.counts[name].items()) < need:
                continue
            found += [(name, n / len(template), start, end) for n, start, end in self._places(words, name, need)]
        return sorted(found, key=lambda x: (-x[1], -len(self.templates[x[0]]), x[0], x[2]))

    def _dense(self, words: list[str], name: str, need: float, reach: int) -> list[int]:
        """Template words of the text from which ``reach`` words hold ``need`` in common with the template."""
        counts = self.counts[name]
        at = [k for k, w in enumerate(words) if w in counts]
        own: Counter[str] = Counter()
        common, hi, dense = 0, 0, []
        for i in at:
            while hi < len(at) and at[hi] < i + reach:
                w = words[at[hi]]
                common += own[w] < counts[w]
                own[w] += 1
                hi += 1
            if common >= need:
                dense.append(i)
            own[words[i]] -= 1
            common -= own[words[i]] < counts[words[i]]
        return dense

    def _places(self, words: list[str], name: str, need: float) -> list[tuple[int, int, int]]:
        """(matched words, start, end) of the places of a template that do not overlap, best first."""
        template = self.templates[name]
        size, reach = len(template), max(1, int(self.stretch * len(template)))
        seen = set()
        for i in self._dense(words, name, need, reach):
            # The short window keeps a neighbouring copy out, the long one lets words be put in.
            for width in {min(size, reach), min(size + size // 4, reach), reach}:
                hits = [p for p, _ in align(words[i : i + width], template)]
                if hits and len(hits) >= need:
                    seen.add((-len(hits), hits[-1] - hits[0], i + hits[0], i + hits[-1] + 1))
        chosen: list[tuple[int, int, int]] = []
        starts: list[int] = []
        ends: list[int] = []
        for n, _, start, end in sorted(seen):
            k = bisect_left(starts, end)
            if k == 0 or ends[k - 1] <= start:
                starts.insert(k, start)
                ends.insert(k, end)
                chosen.append((-n, start, end))
        return chosen


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, stretch: float = 2.0) -> DataFrame:
    """(doc_id, hits) of every whole text of ``docs`` (doc_id, text; other columns are not read).

    ``hits`` are the templates covered, each as often as it stands there, best first: by coverage, then
    the longer template, then the name, then the start; start and end count words of the text.  Null and empty texts have none; rows are kept as
    they are, repeated and null ids too; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = templates or TEMPLATES

    def rows(scanner, keys, texts):
        return keys, [[{"license": a, "coverage": c, "start": s, "end": e} for a, c, s, e in scanner(t)] for t in texts]

    schema = f"doc_id {kind}, hits array<struct<license:string,coverage:double,start:int,end:int>>"
    return map_rows(docs.select("doc_id", "text"), rows, schema, lambda: Scanner(chosen, coverage, stretch))


def best_license(scanned: DataFrame) -> DataFrame:
    """doc_id, license (null: none), coverage, start, end of the best hit, the number of hits and all hits."""
    best = F.get("hits", F.lit(0))
    return scanned.select("doc_id", best["license"].alias("license"), best["coverage"].alias("coverage"), best["start"].alias("start"), best["end"].alias("end"), F.size("hits").alias("n_hits"), "hits")
