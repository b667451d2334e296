"""Operator 8: licence scans by MinHash bands over overlapping text windows.

Templates are licence texts and notices as sets of word shingles (five words;
the whole template if it has fewer).  Templates of similar length form a class;
texts are cut into overlapping windows, one and a quarter times the longest
template of the class long, that advance by the quarter, so a passage as long as
a template lies whole in some window.  From the templates' and the window's
shingles follows the least share of shingles that a window and a template it holds
can have in common; a class has as many bands of one register as such a pair needs
to meet with probability ``1 - MISS``, over 0.9999999.  Windows with fewer
shingles of the class's templates than any of them asks for are left out first.
Each pair that meets is verified on the full shingle sets: the share of the
template's shingles inside the window must reach ``PERCENT``.  Templates of
different licences resemble each other: a hit is dropped if an overlapping hit of
another licence holds all of its shingles and more.

With ``normalize``, words of texts and templates lose the punctuation at their
edges, and words of punctuation alone (comment marks, rules) are no words; places
still count the words between white space.  ``full_templates`` adds the texts in
``license_texts`` and further headers to ``TEMPLATES``.

Edge cases: null and empty texts hold no licence; texts shorter than a window
are one window; a licence that a text holds twice is reported at its best
window, the first among equals; repeated rows are reported one by one; an empty
table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rubric.llm.shingles import U64, chunks, mix, shingle_hashes, text_bytes, word_hashes

SHINGLE = 5
#: Probability that a window and a template it holds meet in no band, at most.
MISS = 0.5 ** 24
PERCENT = 80

# Short public licence notices, by SPDX id.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0-only": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
}

# Further headers and notices; version 2, 3 and "or later" notices name the id of their version.
_GNU = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} Public License "
        "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
HEADERS = {
    "MIT": ["Licensed under the MIT License."],
    "GPL-2.0-only": [
        _GNU.format(what="program", name="General", version="2"),
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation."],
    "LGPL-2.1-only": [_GNU.format(what="library", name="Lesser General", version="2.1")],
    "LGPL-3.0-only": [_GNU.format(what="library", name="Lesser General", version="3")],
    "AGPL-3.0-only": [_GNU.format(what="program", name="Affero General", version="3")],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
}


def full_templates() -> dict[str, list[str]]:
    """``TEMPLATES``, ``HEADERS`` and the licence texts of the package."""
    out = {name: list(texts) for name, texts in TEMPLATES.items()}
    for name, texts in HEADERS.items():
        out.setdefault(name, []).extend(texts)
    for file in resources.files("rubric.llm").joinpath("license_texts").iterdir():
        if file.name.endswith(".txt"):
            out.setdefault(file.name[:-4], []).append(file.read_text(encoding="utf-8"))
    return out


def bare_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place among its text's words) of the words that hold a letter
    or digit, without the punctuation at their edges."""
    n = len(data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    opens = np.zeros(n + 1, bool)
    opens[ends[:-1]] = True
    begin = inside & (opens[:n] | ~np.append(False, inside[:-1])[:n])
    low = data | 32
    solid = ((data >= 48) & (data <= 57)) | ((low >= 97) & (low <= 122)) | (data >= 128)
    if n > 2:  # U+2010..U+203F: dashes, quotes, bullets
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x90))
        for k in range(3):
            solid[mark + k] = False
    at = np.flatnonzero(solid)
    word = (np.cumsum(begin) - 1)[at]
    if len(at) == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.append(True, word[1:] != word[:-1])
    edges = np.zeros(n + 1, np.int64)
    edges[at[new]] += 1
    edges[at[np.append(new[1:], True)] + 1] -= 1
    words, owner = word_hashes(np.where(np.cumsum(edges[:n]) > 0, data, 32).astype(np.uint8), ends)
    firsts = np.append(0, np.cumsum(begin))[ends[:-1]]
    return words, owner, word[new] - firsts[owner]


class Class:
    """Templates of similar length: window, step, shingle sets and band keys."""

    def __init__(self, templates: list[tuple[int, np.ndarray]], longest: int, k: int, percent: int):
        self.step = max(1, math.ceil(longest / 4))
        self.window = longest + self.step
        self.templates = templates
        self.known = np.unique(np.concatenate([grams for _, grams in templates]))
        needs = [-(-percent * len(grams) // 100) for _, grams in templates]
        self.need = min(needs)
        size = max(1, self.window - k + 1)
        common = min(need / (size + len(grams) - need) for need, (_, grams) in zip(needs, templates))
        self.bands = math.ceil(math.log(MISS) / math.log(1 - common)) if common < 1 else 1
        self.keys = []
        for _, grams in templates:
            self.keys.append([_registers(grams, b).min() for b in range(self.bands)])
        self.keys = np.array(self.keys, U64)


def _registers(grams: np.ndarray, band: int) -> np.ndarray:
    return mix(grams + U64(band + 1) * U64(0x9E3779B97F4A7C15))


def _windows_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each range [first, last)."""
    cuts = np.empty(2 * len(first), np.int64)
    cuts[0::2], cuts[1::2] = first, last
    padded = np.append(values, ~U64(0))
    return np.minimum.reduceat(padded, cuts)[0::2]


class Scanner:
    """Finds templates in batches of texts."""

    def __init__(self, templates: dict[str, list[str]], k: int = SHINGLE, percent: int = PERCENT, normalize: bool = False):
        self.k, self.percent = k, percent
        self.names = sorted(templates)
        by_size: dict[tuple[int, int], list] = {}
        for name in self.names:
            for text in templates[name]:
                data = np.frombuffer(text.encode(), np.uint8)
                words, owner = (bare_words if normalize else word_hashes)(data, np.array([0, len(data)]))[:2]
                grams = np.unique(shingle_hashes(words, owner, k, 1)[0])
                by_size.setdefault((len(words) >= k, max(0, len(words) - 1).bit_length()), []).append((self.names.index(name), grams, len(words)))
        self.classes = [Class([(n, g) for n, g, _ in rows], max(w for *_, w in rows), k, percent) for _, rows in sorted(by_size.items())]

    def scan(self, words: np.ndarray, owner: np.ndarray, n_texts: int) -> list[tuple[int, int, int, int, int]]:
        """(text, licence, first word, end word, percent) of each licence held."""
        hits_of: dict[int, list] = {}
        counts = np.bincount(owner, minlength=n_texts)
        starts = np.cumsum(counts) - counts
        grams, gram_owner = shingle_hashes(words, owner, self.k, n_texts)
        n_grams = np.bincount(gram_owner, minlength=n_texts)
        gram_starts = np.cumsum(n_grams) - n_grams
        if len(grams) == 0:
            return []
        for group in self.classes:
            per = np.where(n_grams > 0, np.maximum(1, np.ceil((counts - group.window) / group.step).astype(np.int64) + 1), 0)
            text = np.repeat(np.arange(n_texts), per)
            at = (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * group.step
            size = np.minimum(group.window, counts[text] - at)
            held = np.minimum(np.maximum(size - self.k + 1, 1), n_grams[text] - np.minimum(at, n_grams[text] - 1))
            first = gram_starts[text] + np.minimum(at, n_grams[text] - 1)
            before = np.concatenate([[0], np.cumsum(np.isin(grams, group.known))])
            held_known = before[np.minimum(first + held, len(grams))] - before[first]
            text, at, size, held, first = (x[held_known >= max(1, group.need)] for x in (text, at, size, held, first))
            if len(first) == 0:
                continue
            base = first[0]
            reach = grams[base:first[-1] + held[-1]]
            meets = [[] for _ in group.templates]
            for band in range(group.bands):
                # a window can only meet a template where its least value is the template's
                least = _windows_least(_registers(reach, band), first - base, first + held - base)
                for t in range(len(group.templates)):
                    meets[t].append(np.flatnonzero(least == group.keys[t, band]))
            for (name, own), hits in zip(group.templates, meets):
                for w in np.unique(np.concatenate(hits)):
                    inside = grams[first[w]:first[w] + held[w]]
                    both = own[np.isin(own, inside)]
                    share = 100 * len(both) // len(own)
                    if share >= self.percent:
                        hits_of.setdefault(int(text[w]), []).append((name, (-share, int(at[w]), int(at[w] + size[w])), both))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for t, found in hits_of.items():
            for name, hit, both in found:
                if not any(name != other and len(more) > len(both) and hit[1] < span[2] and span[1] < hit[2] and np.isin(both, more).all()
                           for other, span, more in found):
                    best[t, name] = min(best.get((t, name), hit), hit)
        return [(t, name, lo, hi, -share) for (t, name), (share, lo, hi) in sorted(best.items())]


RESULT = "doc_id long, license string, first_word long, end_word long, percent int"


def find_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, k: int = SHINGLE, percent: int = PERCENT,
                  normalize: bool = False) -> DataFrame:
    """(doc_id, license, first_word, end_word, percent) of each licence that a
    text of (doc_id, text) holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, k, percent, normalize)
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for a, b in chunks(ends):
                part, cuts = data[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
                if normalize:
                    words, owner, place = bare_words(part, cuts)
                    first = np.searchsorted(owner, np.arange(b - a))
                    found = [(t, name, int(place[first[t] + lo]), int(place[first[t] + hi - 1]) + 1, share)
                             for t, name, lo, hi, share in scanner.scan(words, owner, b - a)]
                else:
                    found = scanner.scan(*word_hashes(part, cuts), b - a)
                ids = batch.column("doc_id").slice(a, b - a).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[f[0]] for f in found], pa.int64()), pa.array([scanner.names[f[1]] for f in found], pa.string()),
                     pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int32())],
                    ["doc_id", "license", "first_word", "end_word", "percent"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
