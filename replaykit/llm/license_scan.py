"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Texts and templates become words (ASCII letters in lower case, digits and all non-ASCII bytes; punctuation separates) and
three-word shingles.  Templates of 2**k to 2**(k+1) - 1 shingles form a class with windows of 2**(k+2) shingles that
overlap by half, so an occurrence lies whole inside one window and makes up a quarter of it or more.  With BANDS bands of one
row, ``collision_probability(0.25, BANDS)`` is above 0.99999, and above 0.999 for an occurrence that just
reaches the containment limit.  A window that shares a band with a template is verified on its shingles.

Templates are whole license texts, short notices, license lines and SPDX tags, near variants as templates of their own.
Of matches of different licenses at the same places the best wins: the one with most shingles times containment.

What tells licenses apart, names and versions, is not left to the containment: a short template
matches only where all its shingles with such words stand.

Null and empty texts match nothing.  Each row is scanned by itself, in windows, so long texts need no more memory than
their own shingles.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import ASCII_LOWER, Texts, chunks, mix, word_hashes

WORDS = 3
BANDS = 40
CONTAINMENT = 0.75
SIEVE = 1 << 14
# Of templates up to so many words, every shingle with a word that tells licenses apart, or with a digit, must be held.
NOTICE_WORDS = 64
TELLING = frozenset(
    "gnu affero lesser library general apache mozilla eclipse boost artistic mit isc bsd zlib unlicense clause cc by nc nd sa cc0 "
    "attribution noncommercial noderivatives sharealike only later".split()
)
# The wording of common license notices; whole texts are in the folder licenses.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-2.0", "modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
)
# Names as license lines write them; each stands in the lines of LINES.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "Apache-2.0": ("Apache License, Version 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "CC-BY-NC-ND-4.0": ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0"),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
    "CC-BY-SA-3.0": ("Creative Commons Attribution-ShareAlike 3.0 Unported License", "CC BY-SA 3.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-SA-2.0": ("Creative Commons Attribution-ShareAlike 2.0 Generic License", "CC BY-SA 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "GPL-1.0": ("GNU General Public License, version 1",),
    "GPL-2.0": ("GNU General Public License, version 2",),
    "GPL-3.0": ("GNU General Public License, version 3",),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "MIT": ("MIT License",),
    "MPL-1.1": ("Mozilla Public License, version 1.1",),
    "MPL-2.0": ("Mozilla Public License, version 2.0",),
}
LINES = ("This work is licensed under the {}.", "This work is licensed under a {}.", "Licensed under the {}.", "Licensed under {}.", "Released under the {}.")
VERSIONED = ("AGPL-3.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
TAGS = ("Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "ISC", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib")


def _table() -> tuple[tuple[str, str], ...]:
    whole = [(f.stem, f.read_text(encoding="utf-8", errors="replace")) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    lines = [(name, line.format(x)) for name, xs in NAMES.items() for x in xs for line in LINES]
    tags = [(name, name) for name in (*TAGS, *(x for x in NAMES if x.startswith("CC-")), *VERSIONED)]
    tags += [(name, f"{name}-{end}") for name in VERSIONED for end in ("only", "or-later")]
    return (*NOTICES, *whole, *lines, *((name, f"SPDX-License-Identifier: {tag}") for name, tag in tags))


TEMPLATES = _table()
GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SPACED = bytes(0x20 if GAP[b] else b for b in range(256))
_WEIGHTS = mix(np.arange(101, 101 + WORDS, dtype=np.uint64)) | np.uint64(1)
_FACTORS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def collision_probability(similarity: float, bands: int, rows: int = 1) -> float:
    """Probability that two sets of this Jaccard similarity share a band."""
    return 1 - (1 - similarity**rows) ** bands


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row and the bounds of each text; fewer than three words make no shingle."""
    words, first = word_hashes(texts._replace(data=ASCII_LOWER[texts.data]), GAP)
    n = max(len(words) - WORDS + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(WORDS):
        rolled += words[j : j + n] * _WEIGHTS[j]
    counts = np.maximum(np.diff(first) - WORDS + 1, 0)
    inside = np.zeros(n + 1, np.int64)
    has = counts > 0
    np.add.at(inside, first[:-1][has], 1)
    np.add.at(inside, first[:-1][has] + counts[has], -1)
    return mix(rolled[np.cumsum(inside[:-1]) > 0]), np.concatenate(([0], np.cumsum(counts)))


def required(text: str, values: np.ndarray) -> np.ndarray:
    """Shingles that an occurrence of a notice or line must hold; ``values`` are its shingles in order.  Whole texts have none."""
    words = [w.decode() for w in ASCII_LOWER[np.frombuffer(text.encode(), np.uint8)].tobytes().translate(_SPACED).split()]
    if len(words) > NOTICE_WORDS:
        return values[:0]
    telling = [w in TELLING or any(c.isdigit() for c in w) for w in words]
    return np.unique(values[[any(telling[i : i + WORDS]) for i in range(len(values))]])


class Templates:
    """Template shingle sets by window class, with their band values and required shingles."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.classes: dict[int, list[tuple[str, np.ndarray, np.ndarray]]] = defaultdict(list)
        self.needed: dict[int, list[np.ndarray]] = defaultdict(list)
        for name, text in templates:
            column = pa.array([text])
            values = next(shingles(t) for t in chunks(column))[0]
            own = np.unique(values)
            if len(own):
                self.needed[len(own).bit_length() - 1].append(required(text, values))
                self.classes[len(own).bit_length() - 1].append((name, own, (own[None, :] * _FACTORS[:, None]).min(axis=1)))

        # per class and band: values by template, and a sieve on their low bits
        self.wanted = {k: np.stack([w for _, _, w in ts]) for k, ts in self.classes.items()}
        self.sieves = {k: np.zeros((BANDS, SIEVE), bool) for k in self.classes}
        for k, wanted in self.wanted.items():
            for band in range(BANDS):
                self.sieves[k][band, wanted[:, band] & np.uint64(SIEVE - 1)] = True

    def matches(self, values: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, str, int, float, np.ndarray]]:
        """(text, license, first shingle of the window within the text, containment, places of the template) of verified windows."""
        counts = np.diff(bounds)
        if not len(values):
            return
        lows, firsts, width = None, bounds[:-1], 1  # minima of the pieces of the class before
        for k in sorted(self.classes):
            step = 2 << k
            per_text = -(-counts // step)
            owner = np.repeat(np.arange(len(counts)), per_text)
            ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
            starts = bounds[owner] + ordinal * step
            ends = np.minimum(starts + 2 * step, bounds[owner + 1])
            single = np.append(owner[1:] != owner[:-1], True)
            pieces = firsts[owner] + ordinal * (step // width)
            if lows is None:
                lows = np.stack([np.minimum.reduceat(values * factor, pieces) for factor in _FACTORS])
            else:
                lows = np.minimum.reduceat(lows, pieces, axis=1)
            firsts, width = np.cumsum(per_text) - per_text, step
            hits = set()
            for band in range(BANDS):
                low = lows[band]
                window = np.where(single, low, np.minimum(low, np.append(low[1:], low[-1:])))
                at = np.flatnonzero(self.sieves[k][band][window & np.uint64(SIEVE - 1)])
                w, t = np.nonzero(window[at, None] == self.wanted[k][None, :, band])
                hits.update(zip(at[w].tolist(), t.tolist(), strict=True))
            for w, t in sorted(hits):
                name, own, _ = self.classes[k][t]
                inside = values[starts[w] : ends[w]]
                held = np.isin(own, inside).sum() / len(own)
                if held >= CONTAINMENT and np.isin(self.needed[k][t], inside).all():
                    places = np.flatnonzero(np.isin(inside, own)) + starts[w] - bounds[owner[w]]
                    yield int(owner[w]), name, int(starts[w] - bounds[owner[w]]), float(held), places

    def best(self, values: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, str, int, float]]:
        """Matches without those that lie for more than half in a better match of another license."""
        by_text = defaultdict(list)
        for text, *match in self.matches(values, bounds):
            by_text[text].append(match)
        for text, found in sorted(by_text.items()):
            taken: dict[str, np.ndarray] = {}
            for name, first, held, places in sorted(found, key=lambda m: (-m[2] * len(m[3]), m[0], m[1])):
                others = [x for other, x in taken.items() if other != name]
                if others and 2 * max(np.isin(places, x).sum() for x in others) > len(places):
                    continue
                taken[name] = np.union1d(taken[name], places) if name in taken else places
                yield text, name, first, held


SCAN_SCHEMA = "doc_id bigint, matches array<struct<license:string,first_word:bigint,containment:double>>"


def _scan(templates: tuple[tuple[str, str], ...]):
    kind = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates)
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for texts in chunks(batch.column("text")):
                for text, name, first, held in known.best(*shingles(texts)):
                    found[texts.first + text].append({"license": name, "first_word": first, "containment": held})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "matches"])

    return run


def scanned(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id and the windows that hold a template."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(templates), SCAN_SCHEMA)


def summary(scans: DataFrame) -> DataFrame:
    """One row per document: its licenses in order, their number, and the best containment."""
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return scans.select("doc_id", F.size(names).cast("bigint").alias("n_licenses"), F.array_join(names, ",").alias("licenses"), best.alias("containment"))
