"""License scan by patience alignment.

Words of a text and of a template (lower case, letters and digits with inner points,
hyphens and apostrophes) are aligned: anchors are words unique to both sides, their
longest increasing run of places is kept, and the gaps between anchors are aligned
again the same way. Equal words at the ends of a gap are matched first. The share of
the template's words that are matched is its coverage; from ``COVERAGE`` per cent on it
is a find, with the span of words between its first and last match.

A document is not aligned as a whole: places of the template's distinctive words
(those outside ``COMMON``) that are closer than the template is long are a cluster. Aligned are
the whole cluster, its parts between returns of words that the template has once, and the
ranges where such words stand as in the template, so neither stray words of the template
nor copies hide a notice. What is left beside a find is searched again, so a notice that stands several times is found
several times. To reach the coverage at least one of the rarest words must be there;
documents without any are passed over at once. The templates are constants, so
their number bounds the work per document.

A null text has no words. Repeated rows are documents of their own. Ties (templates
that cover the same words) go to the larger number of matched words, then the name.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_type, source

COVERAGE = 80
_WORD = re.compile(r"[^\W_]+(?:[.\-'’][^\W_]+)*")

#: Words too frequent to lead to a template.
COMMON = frozenset(
    "a an and any are as at be by for from in is it not of on or that the this to under use with you your work".split()
)

#: Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
}


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest increasing run, by patience sorting."""
    tops, piles, back = [], [], []
    for k, p in enumerate(places):
        at = bisect_left(tops, p)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(p)
            piles.append(k)
        else:
            tops[at], piles[at] = p, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of two word lists, both rising: patience alignment with recursion into gaps."""
    out, todo = [], [(0, len(a), 0, len(b))]
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
        left, right = Counter(a[a0:a1]), Counter(b[b0:b1])
        unique = {w for w, n in right.items() if n == 1 and left.get(w) == 1}
        if not unique:
            continue
        where = {w: k for k, w in enumerate(b[b0:b1], b0) if w in unique}
        anchors = [(k, where[w]) for k, w in enumerate(a[a0:a1], a0) if w in unique]
        run = [anchors[k] for k in _rising([y for _, y in anchors])]
        out += run
        for (x0, y0), (x1, y1) in zip([(a0 - 1, b0 - 1), *run], [*run, (a1, b1)], strict=True):
            todo.append((x0 + 1, x1, y0 + 1, y1))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, words(text)
        count = Counter(self.words)
        self.once = {w for w, n in count.items() if n == 1 and w not in COMMON}
        self.where = {w: k for k, w in enumerate(self.words)}
        own = [w for w in self.words if w not in COMMON]
        # Without all of these the coverage can't be reached.
        spare = len(self.words) * (100 - COVERAGE) // 100
        self.need = set(sorted(set(own), key=lambda w: (-len(w), w))[: spare + 1])
        self.own = set(own)

    def clusters(self, text: list[str], places: list[int], cut: bool) -> list[tuple[int, int]]:
        """Word ranges of the text where hits are closer than the template's size; with ``cut`` none holds a once-word twice."""
        size, out, now, seen = len(self.words), [], [], set()
        for p in places:
            again = cut and text[p] in self.once and text[p] in seen
            if now and (p - now[-1] > size or again):
                out.append((now[0], now[-1]))
                now, seen = [], set()
            now.append(p)
            seen.add(text[p])
        if now:
            out.append((now[0], now[-1]))
        ranges = []
        for k, (a, b) in enumerate(out):
            low = max(a - size, out[k - 1][1] + 1 if k else 0)
            high = min(b + size + 1, out[k + 1][0] if k + 1 < len(out) else len(text))
            ranges.append((low, high))
        return ranges

    def diagonals(self, text: list[str], places: list[int]) -> list[tuple[int, int]]:
        """Word ranges where once-words stand as far apart as in the template, about."""
        size = len(self.words)
        slack, out = size // 8 + 1, []
        for d in sorted(p - self.where[text[p]] for p in places if text[p] in self.once):
            if out and d - out[-1][1] <= slack:
                out[-1] = (out[-1][0], d, out[-1][2] + 1)
            else:
                out.append((d, d, 1))
        least = max(1, (len(self.once) - size * (100 - COVERAGE) // 100) // 3)
        return [(max(0, a - slack), min(len(text), b + size + slack)) for a, b, n in out if n >= least]

    def finds(self, text: list[str], places: dict[str, list[int]]) -> list[tuple[int, int, int]]:
        """(first word, behind the last word, words matched) of each find."""
        if not any(w in places for w in self.need):
            return []
        hits = sorted(p for w in self.own for p in places.get(w, ()))
        out, todo = [], [(0, len(text))]
        while todo:
            begin, end = todo.pop()
            if 100 * (end - begin) < COVERAGE * len(self.words):
                continue
            part, own = text[begin:end], [p - begin for p in hits[bisect_left(hits, begin) : bisect_left(hits, end)]]
            tries = {*self.clusters(part, own, False), *self.clusters(part, own, True), *self.diagonals(part, own)}
            met = []
            for low, high in tries:
                got = align(part[low:high], self.words)
                if got and 100 * len(got) >= COVERAGE * len(self.words):
                    met.append((begin + low + got[0][0], begin + low + got[-1][0] + 1, len(got)))
            taken: list[tuple[int, int, int]] = []
            for x in sorted(met, key=lambda x: (-x[2], x[1] - x[0], x[0])):
                if all(x[1] <= y[0] or y[1] <= x[0] for y in taken):
                    taken.append(x)
            if taken:
                # What is left on both sides may hold others.
                taken.sort()
                todo += zip([begin, *(x[1] for x in taken)], [*(x[0] for x in taken), end], strict=True)
                out += taken
        return out


@lru_cache(maxsize=4)
def compiled(items: tuple[tuple[str, str], ...]) -> tuple[list[Template], frozenset[str]]:
    made = [Template(*x) for x in items]
    return made, frozenset(w for t in made for w in t.own)


def scan_text(text: str | None, templates: dict[str, str]) -> list[tuple[str, int, int, int, float]]:
    """(name, first word, behind the last, matched, coverage) of a text's finds, none inside a larger one."""
    made, vocabulary = compiled(tuple(sorted(templates.items())))
    own, places = words(text), {}
    for k, w in enumerate(own):
        if w in vocabulary:
            places.setdefault(w, []).append(k)
    if not places:
        return []
    found = [(t.name, a, b, n, 100 * n / len(t.words)) for t in made for a, b, n in t.finds(own, places)]
    out: list[tuple[str, int, int, int, float]] = []
    for x in sorted(found, key=lambda x: (-x[3], -x[4], x[0], x[1])):
        if all(x[2] <= y[1] or y[2] <= x[1] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1])


FOUND = "doc_id long, n_words long, license string, first_word long, end_word long, matched long, coverage double"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per find; a document without any has one row with nulls after ``n_words``."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        schema = arrow_type(FOUND)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(words(text))
                got = scan_text(text, templates)
                out += [(doc, n, *x) for x in got] or [(doc, n, None, None, None, None, None)]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(source(spark, sf_dir, "documents"))
