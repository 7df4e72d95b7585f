"""License scans: MinHash bands over text windows find templates, shingle containment verifies them.

A template is a license notice. For every template length there are overlapping windows of the text, wide enough
and close enough together that one of them holds a whole notice: windows reach ``STRIDE`` words beyond
the template and start ``STRIDE`` words apart. Windows meet templates in ``BANDS`` bands of ``ROWS`` MinHash values. A
window that just passes has i = three quarters of the template's n distinct shingles and at most ``STRIDE`` more shingles
than the template has places, so J >= i / (n + places + STRIDE - i); it misses all bands with probability
(1 - J^2)^32 at most, computed for every template (``miss``). Templates for which that exceeds ``MISS`` (short
ones) are not left to the bands: every window with one of their shingles retrieves them, so none
of their windows is missed. A retrieved window is verified exactly: at
least ``PERCENT`` per cent of the template's five-word shingles occur in it. Windows without any
template shingle share no MinHash value with one and are skipped before hashing.

Templates are a parameter and broadcast; more than ``LIMIT`` of them are refused. Documents are scanned in
place without a shuffle. Words are runs of ``0-9 a-z`` and non-ASCII characters after lower-casing A-Z.

Defined cases: null and empty texts have no findings; templates of fewer than five words are matched as one
shingle; a template repeated in a text is found at each place (overlapping windows give one finding,
the best); equal templates under two names are both reported; repeated documents are scanned one by
one; no templates: no findings; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kgspark.llm.common import small_batches, worker_cache
from kgspark.llm.decontam import words
from kgspark.llm.neardup import _mix, word_hashes

SHINGLE, BANDS, ROWS, STRIDE, PERCENT, LIMIT = 5, 32, 2, 2, 75, 10_000
#: Templates that the bands would miss with a larger probability are retrieved by their shingles.
MISS = 1e-5
#: Short public notices of common licenses.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
]


def _shingled(found: list[bytes]) -> np.ndarray:
    """Hash of the shingle at every word (a text of fewer words is one shingle)."""
    h = word_hashes(found)
    size = min(SHINGLE, len(h))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - size + 1 + k])
    return out


def miss(distinct: int, places: int) -> float:
    """The largest probability that the bands miss a window that passes, for a template of so many shingles."""
    both = -(-PERCENT * distinct // 100)
    return (1 - (both / (distinct + places + STRIDE - both)) ** ROWS) ** BANDS


class Templates:
    def __init__(self, templates: list[tuple[str, str]]):
        self.factors = np.random.default_rng(8).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.names, self.sets, self.sizes = [], [], []
        self.bands: dict[tuple[int, bytes], list[int]] = {}
        self.direct: dict[tuple[int, int], list[int]] = {}  # (words, shingle): templates retrieved without bands
        self.banded: set[int] = set()  # words of the others
        for name, text in templates:
            w = words(text)
            if w:
                every = _shingled(w)
                s = np.unique(every)
                if miss(len(s), len(every)) > MISS:
                    for x in s.tolist():
                        self.direct.setdefault((len(w), x), []).append(len(self.sets))
                else:
                    self.banded.add(len(w))
                    for k, band in enumerate(self._bands(s)):
                        self.bands.setdefault((k, band), []).append(len(self.sets))
                self.names.append(name)
                self.sets.append(s)
                self.sizes.append(len(w))
        self.all = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)
        self.short = min(self.sizes, default=SHINGLE)

    def _bands(self, s: np.ndarray) -> list[bytes]:
        with np.errstate(over="ignore"):
            low = (s[:, None] * self.factors[None, :]).min(0)
        return [low[k:k + ROWS].tobytes() for k in range(0, BANDS * ROWS, ROWS)]

    def find(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(name, first word, words, containment) of every notice."""
        w = words(text)
        if not w or not self.sets:
            return []
        best: list[tuple[int, int, int, float]] = []
        per_size: dict[int, np.ndarray] = {}
        for size in sorted(set(self.sizes)):
            k = min(SHINGLE, size)
            if k not in per_size:
                per_size[k] = _shingled(w) if k == SHINGLE and len(w) >= SHINGLE else self._runs(w, k)
            at = per_size[k]
            place = np.searchsorted(self.all, at)
            known = np.flatnonzero(self.all[np.minimum(place, len(self.all) - 1)] == at)
            if not len(known):
                continue
            span = size + STRIDE - k + 1  # shingles of a window
            starts = np.unique(np.concatenate([np.arange(max(0, p - span + 1) // STRIDE, p // STRIDE + 1) for p in known.tolist()])) * STRIDE
            for s in starts.tolist():
                window = np.unique(at[s:s + span])
                near = {t for x in window.tolist() for t in self.direct.get((size, x), ())}
                if size in self.banded:
                    near.update(t for b, band in enumerate(self._bands(window)) for t in self.bands.get((b, band), ()))
                for t in near:
                    if self.sizes[t] == size:
                        inside = np.isin(self.sets[t], window)
                        if 100 * int(inside.sum()) >= PERCENT * len(inside):
                            hit = np.flatnonzero(np.isin(at[s:s + span], self.sets[t])) + s
                            best.append((t, int(hit[0]), int(hit[-1] - hit[0]) + k, float(inside.mean())))
        out: dict[tuple[int, int], tuple] = {}
        for t, a, n, c in sorted(best, key=lambda x: (x[0], -x[3], x[1])):
            if not any(u == t and a < b + m and b < a + n for (u, b), (_, m, _) in out.items()):
                out[t, a] = (t, n, c)
        # one place, one name: the best and longest template
        return sorted({(self.names[t], a, n, c) for (t, a), (_, n, c) in out.items()})

    @staticmethod
    def _runs(w: list[bytes], k: int) -> np.ndarray:
        h = word_hashes(w)
        if len(h) < k:
            return np.zeros(0, np.uint64)
        out = np.full(len(h) - k + 1, k, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
        return out


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, word, n_words, containment) for every notice of every document."""
    templates = TEMPLATES if templates is None else templates
    if len(templates) > LIMIT:
        raise ValueError(f"{len(templates)} templates; a scan takes {LIMIT} at most")
    spark = docs.sparkSession
    small_batches(spark)
    sent, key = spark.sparkContext.broadcast(list(templates)), uuid.uuid4().hex
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = worker_cache(f"licenses:{key}", lambda: Templates(sent.value))
        for b in batches:
            row, out = [], []
            for i, t in enumerate(b.column(1)):
                for f in index.find(t.as_py()):
                    row.append(i)
                    out.append(f)
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.float64())))],
                                             ["doc_id", "license", "word", "n_words", "containment"])

    return src.mapInArrow(scan, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, license string, word long, n_words long, containment double")
