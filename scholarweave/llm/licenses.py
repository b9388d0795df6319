"""Operator 1: license scan by winnowed fingerprints and banded alignment.

Templates and texts are sequences of normalised words (runs of letters and digits, A-Z lower-cased).
The winnowed K-word fingerprints of all templates form an inverted index of bounded size; every
K-word hash of a text is looked up in it.  Hits on about the same diagonal make one candidate, which
a banded alignment of template and text confirms; it gives the share of template words matched in
order and the spans of the text that match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import textbatch as tb
from scholarweave.llm.decontam import _PART
from scholarweave.llm.registry import query
from scholarweave.session import ship_package, table

K, WINNOW = 3, 2            # a common run of K + WINNOW - 1 words always shares a fingerprint
MIN_COVERAGE = 0.75
BAND = 0.15                 # half width of the band, in parts of the template's length; at least 3 words

#: License names and notices.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}


def kgram_hashes(words: np.ndarray) -> np.ndarray:
    n = len(words) - K + 1
    weight = tb.constants(K, 51)
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(K):
        out += words[j:j + len(out)] * weight[j]
    return tb.mix(out)


def winnow(hashes: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Positions of the rightmost least hash of every ``window`` neighbours; all of them if there are fewer."""
    if len(hashes) <= window:
        return np.arange(len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


def align(template: list[int], text: list[int], diagonal: int, band: int) -> list[tuple[int, int]]:
    """Pairs (template word, text word) of a longest common subsequence with |j - i - diagonal| <= band."""
    best: list[dict[int, int]] = [{}]            # best[i][j]: matches of template[:i] with text[:j], j in the band
    for i in range(1, len(template) + 1):
        above, row = best[-1], {}
        for j in range(max(0, i + diagonal - band), min(len(text), i + diagonal + band) + 1):
            score = max(above.get(j, 0), row.get(j - 1, 0))
            if j and template[i - 1] == text[j - 1]:
                score = max(score, above.get(j - 1, 0) + 1)
            row[j] = score
        best.append(row)
    i, pairs = len(template), []
    j = max(best[i], key=lambda x: (best[i][x], -x), default=0)
    while i and j:
        score = best[i].get(j, 0)
        if template[i - 1] == text[j - 1] and score == best[i - 1].get(j - 1, 0) + 1:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif score == best[i - 1].get(j, 0):
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


class Templates:
    """Inverted index of the winnowed fingerprints of a bounded set of templates."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names, self.words = [], []
        keys, owner, place = [], [], []
        for name in templates:
            for text in templates[name]:
                data, off = tb.utf8(pa.array([text]))
                start, end, _ = tb.word_bounds(data, off, _PART)
                words = tb.span_hashes(data, start, end)
                hashes = kgram_hashes(words)
                at = winnow(hashes)
                keys.append(hashes[at])
                owner.append(np.full(len(at), len(self.names)))
                place.append(at)
                self.names.append(name)
                self.words.append(words.tolist())
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner, self.place = flat[order], np.concatenate(owner)[order], np.concatenate(place)[order]
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[flat & np.uint64(0xFFFF)] = True
        self.size = np.array([len(w) for w in self.words])
        self.band = np.maximum(3, np.ceil(BAND * self.size).astype(np.int64))

    def candidates(self, words: np.ndarray, woff: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, template, first text word if aligned), one for each group of hits within a band."""
        hashes = kgram_hashes(words)
        hit = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).view(np.int64)])
        lo, hi = np.searchsorted(self.keys, hashes[hit]), np.searchsorted(self.keys, hashes[hit], side="right")
        hit, lo, hi = hit[hi > lo], lo[hi > lo], hi[hi > lo]
        size = hi - lo
        k = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        at = np.repeat(hit, size)
        text = np.searchsorted(woff, at, side="right") - 1
        inside = at + K <= woff[text + 1]
        begin = at - self.place[k]
        rows = np.stack([text, self.owner[k], begin], axis=1)[inside]
        out: list[tuple[int, int, int]] = []
        for t, o, b in rows[np.lexsort(rows.T[::-1])].tolist():
            if not out or out[-1][:2] != (t, o) or b - out[-1][2] > self.band[o]:
                out.append((t, o, b))
        return out

    def scan(self, column: pa.Array) -> list[tuple]:
        """(text, template name, coverage, matched words, start, end, spans) of each confirmed candidate."""
        data, off = tb.utf8(column)
        start, end, woff = tb.word_bounds(data, off, _PART)
        words = tb.span_hashes(data, start, end)
        raw = data.tobytes()
        out = []
        for text, owner, begin in self.candidates(words, woff):
            band, m = int(self.band[owner]), int(self.size[owner])
            a, b = max(int(woff[text]), begin - band), min(int(woff[text + 1]), begin + m + 2 * band)
            pairs = align(self.words[owner], words[a:b].tolist(), begin - a, 2 * band)
            if len(pairs) < MIN_COVERAGE * m:
                continue
            points = lambda to: len(raw[off[text]:to].decode("utf-8", "replace"))  # noqa: E731, B023
            runs: list[list[int]] = []
            for _, j in pairs:
                if runs and j == runs[-1][1] + 1:
                    runs[-1][1] = j
                else:
                    runs.append([j, j])
            spans = [(points(start[a + x]), points(end[a + y])) for x, y in runs]
            out.append((text, self.names[owner], len(pairs) / m, len(pairs), spans[0][0], spans[-1][1],
                        ",".join(f"{x}:{y}" for x, y in spans)))
        return out


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per license passage: doc_id, license, coverage, matched_words, start, end, spans.

    coverage is the share of the template's words matched in order, at least MIN_COVERAGE; start, end
    and spans (``start:end`` of the matching runs) are code points of the text, end exclusive.
    ``templates`` (license -> notices of at least K words) must be small: they are sent to every task.
    Null and empty texts have no passage; repeated rows are scanned each; extra columns are ignored.
    """
    ship_package(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(Templates(templates or TEMPLATES))

    def run(batches):
        for batch in batches:
            for part in tb.chunks(batch, "text"):
                rows = index.value.scan(part.column("text"))
                cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 7
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(cols[0], pa.int64())),
                     *[pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True)]],
                    names=["doc_id", "license", "coverage", "matched_words", "start", "end", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, license string, coverage double, matched_words long, start long, end long, "
                         "spans string")


@query("op1_licenses")
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License passages in the texts of ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents"))
