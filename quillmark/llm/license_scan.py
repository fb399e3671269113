"""Licence scans: a trained classifier of paragraphs, confirmed by comparison with templates.

A paragraph is a run of lines up to a blank one, read as one sequence of words,
so that wrapped lines don't part a notice. Where a stretch of it holds enough of
a template's word pairs, the classifier judges the stretch and the words around;
the family counts if it is the template's. Looking for pairs first leaves out
only what no template could confirm.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Characteristic paragraphs of licence families, as their public texts and usual notices word them.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "The MIT License (MIT)",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
        "This software is licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Distributed under the 3-clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 by the authors. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}

#: Paragraphs about licences, rights and software that grant nothing; they teach the unknown class.
OTHERS = [
    "A driver must hold a valid license and carry it at all times when the car is on a public road.",
    "The version of the story that was released last year is under review by the general public.",
    "She obtained a copy of the book from the library and used it without restriction.",
    "Commons and lords met to discuss the attribution of the work to an unknown author.",
    "The software group at the foundation is free to publish its source code in any form.",
    "You may not use this door except in an emergency, and only with written permission.",
    "The council granted a fishing license to any person who paid the fee.",
    "International terms and conditions apply to all copies sold under this agreement.",
    "The mit and the isc held a meeting; bsd, gpl and apache were on the table with mozilla.",
    "Apache helicopters flew over the distribution center under applicable law.",
    "The public domain of research is broad, and this program is version 3 of its plan.",
    "Copyright law changed in 1976; the notice shall be included in all portions of the report.",
    "He was released under the MIT supervision after the work on the license of the dam.",
    "All rights of the people were reserved to the state in that year.",
    "The rights reserved by the crown were sold to the town.",
]

UNKNOWN = "unknown"
BUCKETS = 1 << 14
#: Words on each side of a stretch that are judged with it.
AROUND = 8
#: Share of a template's word pairs that confirms it: of templates of under ten words more.
CONFIRM, CONFIRM_SHORT = 0.6, 0.7
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def terms(text: str) -> list[str]:
    """Lower-cased words and version numbers."""
    return _WORD.findall(text.lower())


def hashed(words: list[str]) -> dict[int, float]:
    """Hashed counts of 1-, 2- and 3-grams of words, scaled to length one."""
    grams = Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    counts: Counter = Counter()
    for g, c in grams.items():
        counts[zlib.crc32(g.encode()) % BUCKETS] += min(c, 2)
    norm = sum(c * c for c in counts.values()) ** 0.5
    return {k: c / norm for k, c in counts.items()}


def contained(words: list[str], template: list[str]) -> float:
    """Share of a template's word pairs (a one-word template's word) that the text has, counted with repeats."""
    n = min(2, len(template))
    grams = lambda w: Counter(zip(*(w[i:] for i in range(n)), strict=False))
    want = grams(template)
    return sum((want & grams(words)).values()) / max(1, want.total())


def needed(template: list[str]) -> float:
    return CONFIRM if len(template) >= 10 else CONFIRM_SHORT


class Span(NamedTuple):
    """A confirmed stretch of words: first, end, family, probability of the family, share of the template's pairs."""

    first: int
    end: int
    family: str
    probability: float
    share: float


class Model:
    """``weights`` (buckets + 1) x classes, the last class being unknown; ``temperature`` and ``floor`` calibrate it."""

    def __init__(self, families: list[str], weights: np.ndarray, temperature: float, floor: float, templates: dict[str, list[list[str]]]):
        self.families, self.weights, self.temperature, self.floor = families, weights, temperature, floor
        self.templates = [(family, t, Counter(zip(t, t[1:], strict=False))) for family, own in templates.items() for t in own]
        self.pairs: dict[tuple[str, str], list[int]] = {}
        for k, (_, _, pairs) in enumerate(self.templates):
            for x in pairs:
                self.pairs.setdefault(x, []).append(k)
        self.most = {k: -(-int(1000 * needed(t)) * pairs.total() // 1000) for k, (_, t, pairs) in enumerate(self.templates)}

    def probabilities(self, words: list[str]) -> np.ndarray:
        f = hashed(words)
        z = self.weights[-1] + (np.array(list(f.values())) @ self.weights[list(f)] if f else 0)
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()

    def stretches(self, words: list[str]) -> list[tuple[int, int, int, float]]:
        """First word, end, template and share where a stretch of at most twice a template's words holds enough of its pairs."""
        known, hits = self.pairs, {}
        for k, x in enumerate(zip(words, words[1:], strict=False)):
            if x in known:
                for t in known[x]:
                    hits.setdefault(t, []).append((k, x))
        out = []
        for t, own in hits.items():
            if len(own) < self.most[t]:
                continue
            _, template, pairs = self.templates[t]
            total, i = pairs.total(), 0

            def most(i: int, own=own, pairs=pairs, wide=2 * len(template)) -> tuple[int, int]:
                """Pairs of the template from hit ``i`` on, and the last hit that adds one."""
                got, best, end = Counter(), 0, i
                for j in range(i, len(own)):
                    if own[j][0] >= own[i][0] + wide:
                        break
                    if got[own[j][1]] < pairs[own[j][1]]:
                        got[own[j][1]] += 1
                        best, end = best + 1, j
                return best, end

            while i < len(own):
                best, end = most(i)
                if best / total >= needed(template) - 1e-9:
                    while i < end and (later := most(i + 1))[0] >= best and own[later[1]][0] - own[i + 1][0] < own[end][0] - own[i][0]:  # as short as it can be
                        i, (best, end) = i + 1, later
                    out.append((own[i][0], own[end][0] + 2, t, best / total))
                    i = end
                i += 1
        return out

    def spans(self, words: list[str]) -> list[Span]:
        """Confirmed stretches of a paragraph, in order; those of one family that touch or overlap are one, with the largest figures.

        Of stretches of several families that overlap, that with most pairs counts.
        """
        place = {f: k for k, f in enumerate(self.families)}
        sure: list[tuple[float, Span]] = []
        stretches = self.stretches(words)
        for first, end, t, share in stretches:
            family, _, pairs = self.templates[t]
            low = max([first - AROUND, 0, *(b for _, b, o, _ in stretches if b <= first and self.templates[o][0] != family)])
            high = min([end + AROUND, *(a for a, _, o, _ in stretches if a >= end and self.templates[o][0] != family)])
            p = 0.0
            for part in ((low, high), (first, end))[: 1 + (share == 1)]:  # what holds all of a template is judged by itself too
                q = self.probabilities(words[slice(*part)])
                p = max(p, float(q[place[family]] / (q[place[family]] + q[-1])))
            if p >= self.floor:
                sure.append((share * pairs.total(), Span(first, end, family, p, share)))
        kept: list[Span] = []
        for _, x in sorted(sure, key=lambda y: (-y[0], y[1])):
            if not any(x.first < y.end and y.first < x.end and x.family != y.family for y in kept):
                kept.append(x)
        found: list[Span] = []
        for x in sorted(kept):
            if found and found[-1].family == x.family and x.first <= found[-1].end:
                before = found.pop()
                x = Span(before.first, max(x.end, before.end), x.family, max(x.probability, before.probability), max(x.share, before.share))
            found.append(x)
        return found

    def judge(self, paragraph: str) -> tuple[str, float, float] | None:
        """Family, probability and template share of a paragraph's likeliest stretch; None if it is of the unknown class."""
        best = max(self.spans(terms(paragraph)), key=lambda x: x[3:], default=None)
        return best and best[2:]


def fit(negatives: list[str], templates: dict[str, list[str]] = TEMPLATES, others: list[str] = OTHERS, variants: int = 24, steps: int = 150, seed: int = 11) -> Model:
    """Trains on varied copies of the templates against ``others`` and paragraphs of the corpus.

    Variants drop words and put corpus words around them. A fourth of them, and
    of the negatives (by source, so that no copy of one is on both sides), is
    kept back to calibrate: the temperature with the least log loss, and the
    probability (0.3 to 0.9) that one in 200 of the unknown class reaches.
    """
    r = random.Random(seed)
    families = [*sorted(templates), UNKNOWN]
    words = {k: [terms(t) for t in v] for k, v in templates.items()}
    filler = [w for x in negatives for w in terms(x)[:200]] or ["text"]
    data: list[tuple[list[str], int]] = []
    for k, family in enumerate(families[:-1]):
        for t in words[family]:
            for v in range(variants):
                own = list(t)
                if v:
                    own = [w for w in own if r.random() > 0.08 or len(t) < 8] or list(t)
                    if r.random() < 0.7:
                        around = [r.choice(filler) for _ in range(r.randrange(1, 2 * AROUND + 1))]
                        cut = r.randrange(len(around) + 1)
                        own = around[:cut] + own + around[cut:]
                data.append((own, k))
    r.shuffle(data)
    kept_back = data[: len(data) // 4]
    data = data[len(data) // 4 :]
    sources = [[terms(x)[:WINDOW]] for x in negatives] + [[terms(x)] * 8 for x in others]
    sources += [[r.sample(w, min(len(w), 12)) for _ in range(8)] for w in ([y for t in own for y in t] for own in words.values())]  # words of a licence in no order
    sources += [[t[i : i + 3 + k % 5] for i in range(0, max(1, len(t) - 8), 4)] for own in words.values() for k, t in enumerate(own) if len(t) >= 12]  # a few words of a long one
    for k, own in enumerate(sources):
        (kept_back if k % 4 == 3 else data).extend((w, len(families) - 1) for w in own)
    cut = len(data)
    data += kept_back
    rows = [hashed(w) for w, _ in data]
    used = sorted({k for f in rows for k in f})
    place = {k: i for i, k in enumerate(used)}
    column = np.array([k for f in rows for k in (*map(place.__getitem__, f), len(used))])  # a row's features, then one that is always 1
    value = np.array([v for f in rows for v in (*f.values(), 1.0)])
    row = np.repeat(np.arange(len(rows)), [len(f) + 1 for f in rows])
    y = np.eye(len(families))[[k for _, k in data]]
    w = np.zeros((len(families), len(used) + 1))
    step = np.zeros_like(w)
    n = int(np.searchsorted(row, cut))
    for _ in range(steps):  # gradient steps with momentum; a class at a time, so that nothing of rows x features is made
        z = np.stack([np.bincount(row[:n], value[:n] * own[column[:n]], cut) for own in w], axis=1)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        miss = np.ascontiguousarray((p - y[:cut]).T)
        slope = np.stack([np.bincount(column[:n], value[:n] * own[row[:n]], w.shape[1]) for own in miss]) / cut + 1e-5 * w
        step = 0.9 * step - 4.0 * slope
        w += step
    z = np.stack([np.bincount(row[n:] - cut, value[n:] * own[column[n:]], len(rows) - cut) for own in w], axis=1)

    def softmax(t: float) -> np.ndarray:
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: -np.log((softmax(t) * y[cut:]).sum(axis=1) + 1e-12).mean())
    p = softmax(temperature)
    negative = p[y[cut:, -1] == 1][:, :-1].max(axis=1) if y[cut:, -1].any() else np.zeros(1)
    weights = np.zeros((BUCKETS + 1, len(families)))
    weights[used], weights[-1] = w.T[:-1], w.T[-1]
    return Model(families, weights, temperature, float(min(0.9, max(0.3, np.quantile(negative, 0.995)))), words)


#: Documents of the corpus, of at most so many characters, and stretches of them that teach the unknown class.
SAMPLE_DOCS, SAMPLE_CHARS, NEGATIVES = 400, 20_000, 2000
#: Words of a stretch of the corpus that teaches the unknown class.
WINDOW = 24


def paragraphs(text: str | None) -> list[tuple[list[str], list[int], list[str]]]:
    """Of each paragraph with a word: its words, the number of each one's line, and all lines of the text."""
    out, words, at = [], [], []
    lines = (text or "").split("\n")
    for k, line in enumerate(lines):
        own = terms(line)
        if own:
            words += own
            at += [k] * len(own)
        elif words and not line.strip():
            out.append((words, at, lines))
            words, at = [], []
    return [*out, (words, at, lines)] if words else out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, negatives: int = NEGATIVES) -> Model:
    """Fits with stretches of the ``sample_docs`` documents with the least text hashes, among those of ``SAMPLE_CHARS`` characters at most.

    Half of the stretches, where there are so many, hold word pairs of a
    template but none confirms them: the hard cases. Null and empty texts teach
    nothing, equal texts count once; without documents only the fixed texts teach.
    """
    rows = docs.select(F.col("text").cast("string").alias("p")).where(F.length("p").between(1, SAMPLE_CHARS)).withColumn("h", F.xxhash64("p"))
    least = rows.select("h").distinct().orderBy("h").limit(sample_docs).collect()
    if not least:
        return fit([])
    wanted = docs.sparkSession.createDataFrame([(x.h,) for x in least], "h long")  # sample_docs rows at most
    texts = [x.p for x in rows.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.min("p").alias("p")).orderBy("h").collect()]
    known, easy, hard = fit([], variants=2, steps=1), [], []
    for text in texts:
        for words, _, _ in paragraphs(text):
            confirmed = [(a, b) for a, b, _, _ in known.stretches(words)]
            for at in range(0, len(words), WINDOW):
                part = words[at : at + WINDOW]
                if not any(a < at + WINDOW and at < b for a, b in confirmed):
                    (hard if any(x in known.pairs for x in zip(part, part[1:], strict=False)) else easy).append(" ".join(part))
    chosen = [x for own in (hard, easy) for x in sorted(set(own), key=lambda x: (zlib.crc32(x.encode()), x))[: negatives // 2]]
    return fit(sorted(chosen, key=lambda x: (zlib.crc32(x.encode()), x)))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Every licence notice: ``doc_id, line_no, last_line, family, probability, template_share, paragraph`` (its lines).

    Lines are numbered from 0. A paragraph may give several, of one family or
    of several. No shuffle; null and empty texts give no row; repeated rows give
    theirs each; columns other than ``doc_id, text`` aren't read.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, line_no long, last_line long, family string, probability double, template_share double, paragraph string"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string()]

    def run(batches):
        spans = sent.value.spans
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for words, at, lines in paragraphs(text):
                    for x in spans(words):
                        first, last = at[x.first], at[x.end - 1]
                        rows.append((doc_id, first, last, x.family, x.probability, x.share, "\n".join(lines[first : last + 1])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
