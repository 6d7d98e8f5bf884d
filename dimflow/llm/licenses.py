"""License notices found by MinHash over overlapping windows.

Texts and templates become sequences of 5-word shingles (letters and digits, A-Z lower-cased). A template with up to ``s``
shingles, for ``s`` a power of two, is looked for in windows of 2 ``s`` shingles that begin every ``s``, so every occurrence
lies whole in a window. With at least ``CONTAINED`` of the template inside, template and window have a similarity that follows
from their sizes (0.18 or more), and the number of bands, of one minimum each, follows from it: the two share a band with
probability 1 - ``MISS`` or more. Bands are the only way from a window to a template; what they retrieve is verified by exact
containment in the windows of that text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.words import SHINGLE_BASE, SHINGLE_WORDS, chunks, find_words, kept, mix

MISS = 1e-4
CONTAINED = 0.8
TEMPLATE_BYTES = 4 << 20  # of a table of templates, which every task gets whole
NOWHERE = np.uint64(2**64 - 1)

# Wordings of public licence notices.
TEMPLATES = {
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "MIT short": "Released under the MIT License.",
    "MIT grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so""",
    "MIT warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation""",
    "BSD conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met""",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "All rights reserved": "All rights reserved.",
    "MIT reference": "Licensed under the MIT License.",
    "ISC grant": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "ISC warranty": """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "BSD warranty": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED.""",
    "BSD endorsement": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    "LGPL header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation""",
    "AGPL header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation""",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights
        to this software to the public domain worldwide.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "EPL-2.0 header": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at""",
    "BSL-1.0 header": "Distributed under the Boost Software License, Version 1.0.",
    "Zlib warranty": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
        held liable for any damages arising from the use of this software.""",
}


def _letters(text: bytes) -> bytes:
    table = kept("letters", lambda: bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)))
    return text.translate(table)


def sequence(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word shingles at each word."""
    if len(hashes) < size:
        return hashes[:0]
    out = hashes[:len(hashes) - size + 1].copy()
    for k in range(1, size):
        out = out * SHINGLE_BASE + hashes[k:len(hashes) - size + 1 + k]
    return mix(out + np.uint64(size))


@dataclass(frozen=True)
class Template:
    name: str
    words: int  # in a shingle: 5, or all of a shorter template
    shingles: np.ndarray
    step: int

    @property
    def bands(self) -> int:
        """Enough for a window that holds ``CONTAINED`` of the template and whose other shingles are all different."""
        n = len(self.shingles)
        inside = math.ceil(CONTAINED * n)
        return math.ceil(math.log(MISS) / math.log(1 - inside / (2 * self.step + n - inside)))


def prepared(templates: dict[str, str]) -> list[Template]:
    """Templates without a word are left out; one with fewer than five is a single shingle."""
    out = []
    for name, text in templates.items():
        hashes = find_words([_letters((text or "").encode())]).hashes
        if len(hashes):
            size = min(SHINGLE_WORDS, len(hashes))
            shingles = np.unique(sequence(hashes, size))
            length = len(hashes) - size + 1
            out.append(Template(name, size, shingles, 1 << (length - 1).bit_length()))
    return out


@dataclass(frozen=True)
class Bands:
    """The templates of one shingle size and step: for each band the sorted minima and whose they are."""

    words: int
    step: int
    minima: list[np.ndarray]
    owners: list[np.ndarray]


def _band(shingles: np.ndarray, band: int) -> np.ndarray:
    return mix(shingles ^ mix(np.array([band + 1], np.uint64)))


def index(templates: list[Template]) -> list[Bands]:
    out = []
    for words, step in sorted({(t.words, t.step) for t in templates}):
        own = [i for i, t in enumerate(templates) if (t.words, t.step) == (words, step)]
        minima, owners = [], []
        for band in range(max(templates[i].bands for i in own)):
            least = np.array([_band(templates[i].shingles, band).min() for i in own])
            order = np.argsort(least, kind="stable")
            minima.append(least[order])
            owners.append(np.array(own)[order])
        out.append(Bands(words, step, minima, owners))
    return out


def _joined(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima of neighbours two by two within each text, of which there are ``sizes`` values; and the new sizes."""
    begin = np.cumsum(sizes) - sizes
    new = (sizes + 1) // 2
    text = np.repeat(np.arange(len(sizes)), new)
    at = begin[text] + 2 * (np.arange(len(text)) - (np.cumsum(new) - new)[text])
    return np.minimum.reduceat(values, at) if len(at) else values, new


def retrieved(hashes: np.ndarray, first: np.ndarray, bands: list[Bands]) -> set[tuple[int, int]]:
    """(text, template) wherever a window of the text shares a band with the template."""
    found: set[tuple[int, int]] = set()
    counts = np.diff(first)
    for words in sorted({b.words for b in bands}):
        levels = {b.step: b for b in bands if b.words == words}
        shingles = sequence(hashes, words)
        # those that run over the end of their text count for none
        over = np.repeat(first[1:], counts)[:len(shingles)] < np.arange(len(shingles)) + words
        if not len(shingles):
            continue
        sizes = np.diff(np.minimum(first, len(shingles)))
        for band in range(max(len(b.minima) for b in levels.values())):
            values, of = _band(shingles, band), sizes
            values[over] = NOWHERE
            step = 1
            while step <= max(levels):
                level = levels.get(step)
                if level is not None and band < len(level.minima):
                    # a window is two pieces of a text, the last one its last piece alone
                    window = np.minimum(values, np.append(values[1:], NOWHERE))
                    last = np.cumsum(of)[of > 0] - 1
                    window[last] = values[last]
                    minima = level.minima[band]
                    left = np.searchsorted(minima, window)
                    hit = np.flatnonzero(minima[np.minimum(left, len(minima) - 1)] == window)
                    if len(hit):
                        right = np.searchsorted(minima, window[hit], side="right")
                        text = np.searchsorted(np.cumsum(of), hit, side="right")
                        for t, low, high in set(zip(text.tolist(), left[hit].tolist(), right.tolist())):
                            found.update((t, o) for o in level.owners[band][low:high].tolist())
                values, of = _joined(values, of)
                step *= 2
    return found


def verified(hashes: np.ndarray, t: Template) -> tuple[str, float, int, int] | None:
    """(name, containment, first word, windows) of a template in a text: the best window, and how many hold enough."""
    shingles = sequence(hashes, t.words)
    hits = np.flatnonzero(np.isin(shingles, t.shingles))
    best, windows = (0.0, 0), 0
    begins = np.unique(np.concatenate([hits // t.step, hits // t.step - 1]))
    for begin in (begins[begins >= 0] * t.step).tolist():
        window = np.unique(shingles[begin:begin + 2 * t.step])
        contained = len(np.intersect1d(window, t.shingles, assume_unique=True)) / len(t.shingles)
        if contained >= CONTAINED:
            windows += 1
            best = max(best, (contained, -int(hits[np.searchsorted(hits, begin)])))
    return (t.name, best[0], -best[1], windows) if windows else None


def templates_of(table: DataFrame, limit: int = TEMPLATE_BYTES) -> dict[str, str]:
    """Templates from a table (name, text), which must be small: beyond ``limit`` bytes it is refused. NULL names or texts are
    left out; of equal names the smallest text is taken."""
    rows = table.filter("name IS NOT NULL AND text IS NOT NULL").groupBy("name").agg(F.min("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    if size > limit:
        raise ValueError(f"{size} bytes of templates, more than {limit}")
    return {r["name"]: r["text"] for r in rows.collect()}


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """doc_id, license, containment, first_word, windows: a row for each template found in a row of ``docs`` (doc_id, text).

    ``templates`` are wordings by name, or a small table (name, text). Whole texts are scanned. NULL, empty and blank texts
    have no matches; repeated rows have theirs repeated.
    """
    if isinstance(templates, DataFrame):
        templates = templates_of(templates)
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = prepared(templates)
        bands = index(own)
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for begin, texts in chunks(batch.column("text")):
                words = find_words([_letters(t) for t in texts])
                for i, t in sorted(retrieved(words.hashes, words.first, bands)):
                    found = verified(words.hashes[words.first[i]:words.first[i + 1]], own[t])
                    if found:
                        rows.append((ids[begin + i], *found))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "license", "containment", "first_word", "windows"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, containment double, first_word long, windows long")
