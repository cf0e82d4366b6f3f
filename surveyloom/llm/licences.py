"""License scans: winnowed fingerprints find templates, banded alignment measures them.

Texts and templates are words (lower-cased runs of letters and digits). Hashes of
``gram`` words in a row are winnowed: of every ``window`` neighbours the smallest
is kept, so any shared run of gram + window − 1 words shares a fingerprint. The
templates' fingerprints form an inverted index; the fingerprints that a document
shares with a template fall into bands of nearby diagonals, and each band is
aligned word by word (match 2, mismatch and gap −1) within ``band`` words of its
diagonals.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.common import texts_of

#: License notices by SPDX identifier, as their licences word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT-notice", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
#: ASCII other than letters and digits as blanks; letters in lower case.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` word hashes in a row."""
    n = len(words) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            out = (out ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash (the rightmost of equal ones) of every ``window`` neighbours."""
    n = len(hashes)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))]) if n else np.zeros(0, np.int64)
    best = np.full(n - window + 1, window - 1)
    low = hashes[window - 1 :].copy()
    for k in range(window - 2, -1, -1):
        part = hashes[k : k + n - window + 1]
        better = part < low
        low[better] = part[better]
        best[better] = k
    return np.unique(np.arange(n - window + 1) + best)


def align(doc: Sequence[bytes], template: Sequence[bytes], low: int, high: int) -> tuple[int, int, int, int, int]:
    """Best local alignment on diagonals low…high (document − template position).

    (matched words, document start, document end, template start, template end); ends are exclusive.
    """
    best, width = (0, 0, 0, 0, 0, 0), high - low + 1
    before = [(0, 0, None)] * (width + 2)  # score, matched, start; one cell of margin on each side
    for j, word in enumerate(template):
        row = [(0, 0, None)] * (width + 2)
        for d in range(width):
            i = j + low + d
            if not 0 <= i < len(doc):
                continue
            score, matched, start = before[d + 1]
            same = doc[i] == word
            cell = (score + (2 if same else -1), matched + same, start or (i, j))
            for other in (row[d], before[d + 2]):  # a word more in the document, one more in the template
                if other[0] - 1 > cell[0]:
                    cell = (other[0] - 1, other[1], other[2])
            row[d + 1] = cell if cell[0] > 0 else (0, 0, None)
            if cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2][0], i + 1, cell[2][1], j + 1)
        before = row
    return best[1:]


class Index:
    """Templates by fingerprint; the parameters bound its size."""

    def __init__(self, templates: Sequence[tuple[str, str]], gram: int, window: int):
        self.gram, self.window, self.words, self.known = gram, window, {}, set()
        self.postings: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, text in templates:
            words = text.encode().translate(TABLE).split()
            self.words[name] = words
            hashes = gram_hashes(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64), gram)
            for at in winnow(hashes, window).tolist():
                self.postings[int(hashes[at])].append((name, at))
        self.sorted = np.array(sorted(self.postings), np.uint64)

    def scan(self, text: bytes, hash_of: dict[bytes, int], band: int, coverage: float) -> Iterator[tuple]:
        """(template, start, end, matched words, template words) of each match; code points, end exclusive."""
        lowered = text.translate(TABLE)
        words = lowered.split()
        if not len(self.sorted) or len(words) < self.gram:
            return
        hashes = gram_hashes(np.fromiter(map(hash_of.__getitem__, words), np.uint64, len(words)), self.gram)
        kept = winnow(hashes, self.window)
        at = np.minimum(np.searchsorted(self.sorted, hashes[kept]), len(self.sorted) - 1)
        hits = kept[self.sorted[at] == hashes[kept]]
        if not len(hits):
            return
        bands: dict[str, list[int]] = defaultdict(list)
        for i in hits.tolist():
            for name, j in self.postings[int(hashes[i])]:
                bands[name].append(i - j)
        places = None
        for name, diagonals in sorted(bands.items()):
            template = self.words[name]
            diagonals = sorted(set(diagonals))
            groups, last = [[diagonals[0]]], diagonals[0]
            for d in diagonals[1:]:
                if d - last > band:
                    groups.append([])
                groups[-1].append(d)
                last = d
            for group in groups:
                matched, start, end, *_ = align(words, template, group[0] - band, group[-1] + band)
                if matched >= coverage * len(template):
                    places = places or [m.span() for m in WORD.finditer(lowered)]
                    a, b = places[start][0], places[end - 1][1]
                    first = len(text[:a].decode("utf-8", "replace"))
                    yield name, first, first + len(text[a:b].decode("utf-8", "replace")), matched, len(template)


def scan_licences(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, *, doc_id: str = "doc_id", text: str = "text",
    gram: int = 3, window: int = 2, band: int = 4, coverage: float = 0.8,
) -> DataFrame:
    """(doc_id, template, start, end, matched, n_words, coverage): where at least ``coverage`` of a template's words stand.

    One row per match, repeated rows each for themselves; start and end are code
    points. Null and empty texts have none. Templates shorter than ``gram`` words
    are never found.
    """
    index = Index(templates, gram, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Hashes(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = out = xxhash.xxh64_intdigest(word)
                return out

        hash_of = Hashes()
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body:
                    rows += [(doc, *m) for m in index.scan(body, hash_of, band, coverage)]
                if len(hash_of) > 500_000:
                    hash_of.clear()
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "template", "start", "end", "matched", "n_words"]
            )

    narrow = texts_of(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = narrow.mapInArrow(run, "doc_id long, template string, start long, end long, matched long, n_words long")
    return found.withColumn("coverage", F.col("matched") / F.col("n_words"))
