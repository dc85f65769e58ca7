"""Licence scan: logistic regression over word n-grams names a family, templates confirm it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm.common import read_table, register, text_of

# Usual notices of each family. {name} stands for a holder or work.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GPL version 2 or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Distributed under the terms of the Creative Commons Attribution License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, {name} has waived all copyright and related or neighboring rights to this work.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "Copyright {name}. All rights reserved.",
        "This document is confidential and may not be reproduced without the written permission of {name}.",
    ],
}
# Licence language of no family, for the unknown class.
UNKNOWN = [
    "Licensed under the {name} License.",
    "Licensed under the {name} Public License, version {number}.",
    "Released under the {name} license terms.",
    "Use of this work is subject to the {name} agreement.",
    "You may copy and share this text under the {name} terms.",
    "This material is made available under licence {name} {number}.",
]
NONE, OTHER = "none", "unknown"
FEATURES = 1 << 16
NEGATIVES = 2_000  # ordinary paragraphs that the model is trained on, at most
NEGATIVE_CHARS = 400
VARIANTS = 40  # altered copies of each template
EMBEDDED = 20  # copies of each template inside ordinary text
LONGEST, STRIDE = 24, 8  # words of a piece of a long paragraph, and the step between pieces
SURE, LIKE = 0.7, 0.5  # probability of a family, and share of a template's word pairs that confirms it
PLAIN_LIKE = 0.8  # share from which a template's place is licence language whatever the model says of ordinary text
SAMPLED = 4_000  # documents whose lines the ordinary paragraphs come from, about
MARKS = ".,;:!?|()\"'"
FOUND = "doc_id long, first_word int, end_word int, family string, probability double, likeness double"


class _Words(dict):
    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        out = zlib.crc32(word.lower().strip(MARKS).encode())
        if len(word) <= 40:
            self[word] = out
        return out

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_WORDS = _Words()


def features(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bins of every word and of every pair of neighbours."""
    return words % (FEATURES // 2), _pair_bins(words[:-1], words[1:])


def _pair_bins(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    half = FEATURES // 2
    return half + ((first * 40_503 + second * 31_321) >> 7) % half


def pair_codes(words: np.ndarray) -> np.ndarray:
    return words[:-1] << 32 | words[1:]


@dataclass
class Template:
    """Word pairs of a notice with the place of each in it."""

    family: str
    length: int
    codes: np.ndarray  # sorted
    places: np.ndarray

    @classmethod
    def of(cls, family: str, text: str) -> Template:
        words = _WORDS.of(text.replace("{name}", "").replace("{number}", "").split())
        codes, places = np.unique(pair_codes(words), return_index=True)
        return cls(family, len(words), codes, places)

    def likeness(self, words: np.ndarray) -> float:
        """Share of the notice's word pairs that stand in ``words``."""
        return len(np.intersect1d(self.codes, pair_codes(words))) / max(len(self.codes), 1)

    def spots(self, codes: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """Where enough of the pairs stand close together: pairs ``codes`` occur at the places ``at``."""
        mine = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[mine] == codes
        at, mine = at[hit], self.places[mine[hit]]
        need = max(1, int(np.ceil(LIKE * len(self.codes))))
        if len(at) < need:
            return []
        last = np.searchsorted(at, at + self.length + 2) - 1
        starts = np.flatnonzero(last - np.arange(len(at)) + 1 >= need)
        out: list[tuple[int, int]] = []
        for i in starts.tolist():
            spot = (int(at[i] - mine[i]), int(at[last[i]] - mine[last[i]] + self.length))
            if not out or spot[0] >= out[-1][1]:
                out.append(spot)
        return out


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray  # (FEATURES, classes)
    bias: np.ndarray
    temperature: float
    templates: list[Template]

    def __post_init__(self):
        self.codes = np.unique(np.concatenate([t.codes for t in self.templates]))
        self.bins = np.zeros(FEATURES, bool)
        first, second = self.codes >> 32, self.codes & 0xFFFFFFFF
        self.bins[_pair_bins(first, second)] = True

    def proposals(self, words: np.ndarray, pairs: np.ndarray, paragraphs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Pieces where a template stands, however short and wherever in its paragraph."""
        at = np.flatnonzero(self.bins[pairs])
        if not len(at):
            return []
        codes = words[at] << 32 | words[at + 1]
        known = self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] == codes
        at, codes = at[known], codes[known]
        if not len(at):
            return []
        ends = np.array([b for _, b in paragraphs])
        out = []
        for t in self.templates:
            for a, b in t.spots(codes, at):
                # a piece does not leave the paragraph in which most of it lies
                low, high = paragraphs[min(int(np.searchsorted(ends, (a + b) // 2, side="right")), len(ends) - 1)]
                if max(a, low) < min(b, high):
                    out.append((max(a, low), min(b, high)))
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def pieces(self, words: np.ndarray, paragraphs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out = []
        for a, b in paragraphs:
            starts = range(a, max(a + 1, b - LONGEST + STRIDE), STRIDE) if b - a > LONGEST else (a,)
            out += [(s, min(b, s + LONGEST)) for s in starts]
        return out

    def scan(self, words: np.ndarray, paragraphs: list[tuple[int, int]]) -> list[tuple[int, int, str, float, float]]:
        """(first, end, family, probability, likeness) of the pieces that are not ordinary text, merged where they overlap."""
        if not len(words):
            return []
        one, two = features(words)
        total = np.zeros((len(words) + 1, len(self.classes)))
        np.cumsum(self.weights[one], axis=0, out=total[1:])
        pair = np.zeros((len(words), len(self.classes)))
        np.cumsum(self.weights[two], axis=0, out=pair[1:])
        pieces = self.pieces(words, paragraphs)
        offered = self.proposals(words, two, paragraphs)
        a, b = np.array(pieces + offered).T
        n = np.maximum(2 * (b - a) - 1, 1)
        logits = (total[b] - total[a] + pair[np.maximum(b - 1, 0)] - pair[a]) / np.sqrt(n)[:, None] + self.bias
        p = self.probabilities(logits)
        none = self.classes.index(NONE)
        looked = p[:, none] < 0.5
        looked[len(pieces):] = True
        hits = []
        for i in np.flatnonzero(looked).tolist():
            piece, q = words[a[i]:b[i]], p[i]
            if q[none] >= 0.5:
                # the templates have a word before the piece is dismissed
                if max((t.likeness(piece) for t in self.templates), default=0.0) < PLAIN_LIKE:
                    continue
                q = np.where(np.arange(len(q)) == none, 0.0, q) / max(1.0 - q[none], 1e-12)
            family, likeness = self.confirmed(q, piece)
            if family == OTHER and not np.isin(pair_codes(piece), self.codes).any():
                continue  # not two words together that any notice has
            hits.append((int(a[i]), int(b[i]), family, float(q.max() if family == OTHER else q[self.classes.index(family)]), likeness))
        return _joined(hits)

    def confirmed(self, p: np.ndarray, words: np.ndarray) -> tuple[str, float]:
        """The family if it is sure and one of its templates is there, else unknown."""
        best = self.classes[int(p.argmax())]
        like = max((t.likeness(words) for t in self.templates if t.family == best), default=0.0)
        return (best, like) if best not in (NONE, OTHER) and p.max() >= SURE and like >= LIKE else (OTHER, like)


def _joined(hits: list[tuple[int, int, str, float, float]]) -> list[tuple[int, int, str, float, float]]:
    """Overlapping hits of one family as one, in order; an unknown one gives way to a named one that it overlaps."""
    out: dict[str, list] = {}
    for hit in sorted(hits):
        own = out.setdefault(hit[2], [])
        if own and own[-1][1] > hit[0]:
            last = own.pop()
            hit = (last[0], max(last[1], hit[1]), hit[2], max(last[3], hit[3]), max(last[4], hit[4]))
        own.append(hit)
    named = sorted(h for f, own in out.items() if f != OTHER for h in own)
    ends = np.maximum.accumulate([h[1] for h in named]) if named else np.zeros(0)
    starts = np.array([h[0] for h in named])
    free = [h for h in out.get(OTHER, []) if not (k := int(np.searchsorted(starts, h[1]))) or ends[k - 1] <= h[0]]
    return sorted(named + free)


def _altered(text: str, rng: np.random.Generator, names: list[str]) -> list[str]:
    """A template with words lost or put in, as found in the wild."""
    text = text.replace("{name}", " ".join(rng.choice(names, rng.integers(1, 3)))).replace("{number}", str(rng.integers(1, 9)))
    words = [w for w in text.split() if rng.random() > 0.08]
    for _ in range(rng.integers(0, 3)):
        words.insert(int(rng.choice([0, len(words)])), str(rng.choice(names)))
    return words


def train(negatives: list[str], seed: int = 11) -> Model:
    """Softmax regression over altered templates, unknown notices and ordinary paragraphs.

    A fifth of the examples is held out and gives the temperature that calibrates the probabilities.
    """
    rng = np.random.default_rng(seed)
    names = sorted({w.strip(MARKS) for t in negatives for w in t.split()} - {""})[:20_000] or ["work"]
    classes = [*TEMPLATES, OTHER, NONE]
    rows: list[tuple[list[str], int]] = []
    for c, (family, texts) in enumerate(TEMPLATES.items()):
        rows += [(_altered(t, rng, names), c) for t in texts for _ in range(VARIANTS)]
    rows += [(_altered(t, rng, names), len(classes) - 2) for t in UNKNOWN for _ in range(VARIANTS)]
    prose = [w for w in (t.split() for t in negatives) if len(w) >= 4]
    if prose:
        # notices inside ordinary text, as a piece of a long paragraph shows them
        for words, c in [r for n, r in enumerate(list(rows)) if n % VARIANTS < EMBEDDED]:
            before, after = (prose[int(rng.integers(len(prose)))] for _ in range(2))
            room = max(0, LONGEST - len(words))
            k = int(rng.integers(0, room + 1))
            rows.append((([*before[-k:]] if k else []) + words + after[:room - k], c))
    for t in negatives:
        words = t.split()[:LONGEST]
        # beside the paragraph a short piece of words that no one has seen: what is unknown is ordinary
        rows += [(words, len(classes) - 1), ([f"{w}~{rng.integers(1 << 30)}" for w in words[:rng.integers(1, 8)]], len(classes) - 1)]
    rows = [r for r in rows if r[0]]
    sets = [np.concatenate(features(_WORDS.of(words))) for words, _ in rows]
    y = np.array([c for _, c in rows])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = 1 / np.sqrt(np.repeat([max(len(s), 1) for s in sets], [len(s) for s in sets]))
    used, col = np.unique(np.concatenate(sets), return_inverse=True)
    held = rng.random(len(y)) < 0.2
    goal = np.eye(len(classes))[y]
    # ordinary paragraphs weigh as much as all notices together, and the families alike
    size = np.bincount(y, minlength=len(classes))
    share = (~held) / np.maximum(size[y], 1) / np.where(y == len(classes) - 1, 2, 2 * len(classes) - 2)
    w, bias = np.zeros((len(used), len(classes))), np.zeros(len(classes))
    moment, square = np.zeros_like(w), np.zeros_like(w)

    def logits() -> np.ndarray:
        out = np.zeros((len(y), len(classes)))
        for c in range(len(classes)):
            out[:, c] = np.bincount(row, w[col, c] * value, len(y))
        return out + bias

    for step in range(1, 81):
        z = logits()
        e = np.exp(z - z.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - goal) * share[:, None]
        grad = np.stack([np.bincount(col, error[row, c] * value, len(used)) for c in range(len(classes))], axis=1) + 1e-6 * w
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= 0.3 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        bias -= 2.0 * error.sum(axis=0)
    full = np.zeros((FEATURES, len(classes)))
    full[used] = w
    templates = [Template.of(f, t) for f, ts in [*TEMPLATES.items(), (OTHER, UNKNOWN)] for t in ts]
    model = Model(classes, full, bias, 1.0, [t for t in templates if len(t.codes)])
    z = logits()[held]
    if len(z):
        def loss(temperature: float) -> float:
            model.temperature = temperature
            return -np.log(model.probabilities(z)[np.arange(len(z)), y[held]] + 1e-12).mean()

        model.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    return model


def sample_paragraphs(docs: DataFrame) -> list[str]:
    """At most ``NEGATIVES`` lines without licence language of about ``SAMPLED`` documents, by hash, at most ``NEGATIVE_CHARS`` characters of each.

    The share of documents is taken from their number, so the lines that tasks offer to the driver
    do not grow with the table.
    """
    share = min(1.0, SAMPLED / max(docs.count(), 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", text_of()), F.lit(1 << 30)) < int(share * (1 << 30)))
    lines = chosen.select(F.explode(F.split(text_of(), "\n")).alias("line")).where(F.trim("line") != "")
    plain = lines.where(~F.lower("line").rlike("licen[cs]|copyright|permi(t|ss)|public domain|rights reserved"))
    short = plain.select(F.substring("line", 1, NEGATIVE_CHARS).alias("line")).distinct()
    return [r["line"] for r in short.orderBy(F.xxhash64("line"), "line").limit(NEGATIVES).collect()]


def find_licences(docs: DataFrame) -> DataFrame:
    """One row for each licence notice: doc_id, first_word, end_word, family, probability, likeness.

    Paragraphs are lines; those above ``LONGEST`` words are judged in overlapping pieces, and so is
    every place where enough of a template's word pairs stand together, however short. Overlapping
    pieces of one family are one notice. A family needs its probability and a template
    that confirms it; licence language without both is ``unknown``, unless a named notice overlaps it. Null and empty texts have
    no notices; repeated rows are scanned alike; an empty table gives no rows; other columns are not
    read. The ordinary paragraphs that the model learns from are a bounded sample; every paragraph is
    judged.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(sample_paragraphs(docs)))
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words: list[str] = []
                paragraphs = []
                for line in text.split("\n"):
                    part = line.split()
                    if part:
                        paragraphs.append((len(words), len(words) + len(part)))
                        words += part
                out += [(doc_id, *hit) for hit in model.value.scan(_WORDS.of(words), paragraphs)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(scan, FOUND)


@register("op4_licence_scan")
def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_licences(read_table(spark, folder, "documents"))
