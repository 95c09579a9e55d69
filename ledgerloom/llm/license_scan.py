"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line, or in a longer line each of the overlapping windows of ``WINDOW`` words that cover it,
so that what stands around a notice doesn't outweigh it. Its features are the word uni- and bigrams that
templates have; a multinomial logistic regression over the licence families and an unknown class is trained
on varied templates, alone and inside windows of text, against windows of a bounded sample of the corpus's
own lines, and its probabilities are calibrated by temperature on examples held out from training. A
prediction counts as confirmed if the words in and beside the window have enough of one of the family's templates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import flat_bytes, mix64, span_hashes, tidy

SAMPLE_DOCUMENTS = 1500  # whose lines are the background, about
SAMPLE_LINES = 6000  # lines of background at most
WINDOW = 24  # words that are scored together
STRIDE = 8  # words from one window to the next
LEAST_PROBABILITY = 0.5
LEAST_CONTAINMENT = 0.5  # of a template's bigrams, for a prediction to be confirmed
_PART = 1_000  # characters of a line of background
_TEXT_BYTES = 1 << 20
_HITS = 1 << 16  # n-grams of lines that are scored at once, about

UNKNOWN = "unknown"

# Notices by which licences are named or granted, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "creative-commons": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the GNU Affero General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "Distributed under the terms of the MIT license.",
    ),
    "mozilla": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: Unlicense",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ),
}

# Lines that speak of licences without granting one of these.
NOT_TEMPLATES = (
    "All rights reserved.",
    "A driving license is required to apply for this position.",
    "The software is licensed, not sold, to the general public.",
    "See the license for details.",
    "Licensed under the terms agreed with the customer.",
    "Released under the name of the author.",
    "This work is protected by copyright and may not be copied without permission.",
    "The university of Apache county offers a general education.",
    "The following conditions are met by most people with a public license to operate.",
    "Version 2.0 of the program was released to the general public.",
    "You may not use this service without a license from the owner.",
    "Permission to record the meeting was granted free of charge.",
)

_TOKEN = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
for _first, _last in ("az", "AZ", "09"):
    _INSIDE[ord(_first) : ord(_last) + 1] = True


def _spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, runs of letters and digits, and where each line's words begin, the end last."""
    inside = _INSIDE[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = offsets[:-1][offsets[:-1] < len(raw)], offsets[1:][offsets[1:] > 0] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _ngrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all uni- and bigrams, and each one's line."""
    starts, ends, first = _spans(raw, offsets)
    words = span_hashes(raw, starts, ends, lower=True)
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pairs = line[1:] == line[:-1]
    both = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[pairs]
    return np.concatenate([words, both]), np.concatenate([line, line[:-1][pairs]])


def _covers(n: np.ndarray) -> np.ndarray:
    """How many windows cover lines of so many words; the last may be shorter."""
    return 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))


@dataclass
class Model:
    families: list[str]
    grams: np.ndarray  # sorted hashes
    weights: np.ndarray  # n-grams by classes, the last class being unknown
    bias: np.ndarray
    temperature: float

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line and feature of all n-grams that templates have, and every line's number of n-grams."""
        grams, line = _ngrams(raw, offsets)
        total = np.bincount(line, minlength=len(offsets) - 1)
        at = self.lookup(grams)
        known = at >= 0
        return line[known], at[known], total

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        near = self.table[(grams >> np.uint64(44)).astype(np.int64)]
        hit = np.flatnonzero(near)
        at = np.searchsorted(self.grams, grams[hit])
        at = np.minimum(at, len(self.grams) - 1)
        out = np.full(len(grams), -1)
        out[hit] = np.where(self.grams[at] == grams[hit], at, -1)
        return out

    def __post_init__(self):
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and probability of every line as a whole; lines without a template's n-gram are unknown."""
        return self.classify(*self.counts(raw, offsets))

    def score_windows(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Line, first word in it, class and probability of every window, from the hashes of all words and where lines begin."""
        n = np.diff(first)
        many = _covers(n)
        base = np.concatenate(([0], np.cumsum(many)))
        line = np.repeat(np.arange(len(n)), many)
        begin = (np.arange(base[-1]) - base[line]) * STRIDE
        of_word = np.repeat(np.arange(len(n)), n)
        both = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
        rows, ats = [], []
        for size, grams in ((1, words), (2, both)):
            at = self.lookup(grams)
            hit = np.flatnonzero(at >= 0)
            hit = hit[of_word[hit] == of_word[hit + size - 1]]
            offset = hit - first[of_word[hit]]
            low = np.maximum(0, -((WINDOW - size - offset) // STRIDE))
            times = np.minimum(many[of_word[hit]] - 1, offset // STRIDE) - low + 1
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows.append(np.repeat(base[of_word[hit]] + low, times) + within)
            ats.append(np.repeat(at[hit], times))
        total = np.maximum(0, 2 * np.minimum(WINDOW, n[line] - begin) - 1)
        return line, begin, *self.classify(np.concatenate(rows), np.concatenate(ats), total)

    def classify(self, line: np.ndarray, at: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind, probability = np.full(len(total), len(self.families)), np.ones(len(total))
        lines, where = np.unique(line, return_inverse=True)
        if len(lines):
            order = np.argsort(where, kind="stable")
            begins = np.searchsorted(where[order], np.arange(len(lines) + 1))
            for lo in range(0, len(lines), 4096):
                hi = min(lo + 4096, len(lines))
                rows = order[begins[lo] : begins[hi]]
                sums = np.zeros((hi - lo, self.weights.shape[1]))
                for cut in range(0, len(rows), _HITS):
                    part = rows[cut : cut + _HITS]
                    np.add.at(sums, where[part] - lo, self.weights[at[part]])
                p = self.probabilities(sums / np.sqrt(total[lines[lo:hi]])[:, None] + self.bias)
                kind[lines[lo:hi]], probability[lines[lo:hi]] = p.argmax(axis=1), p.max(axis=1)
        return kind, probability


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return flat_bytes(pa.array(texts, pa.string()))


def _pieces(texts: list[str]) -> list[str]:
    """Texts cut into windows that don't overlap."""
    return [" ".join(words[at : at + WINDOW]) for words in map(_words, texts) for at in range(0, len(words), WINDOW)]


def _within(text: str, around: str, rnd: np.random.Generator) -> str:
    """A text somewhere in others' words, a window together."""
    words = around.split()[: max(0, WINDOW - len(_words(text)))]
    cut = rnd.integers(0, len(words) + 1)
    return " ".join([*words[:cut], text, *words[cut:]])


def _varied(text: str, rnd: np.random.Generator) -> str:
    """A template with other numbers, words left out, and others around it."""
    words = [w if not w.isdigit() or rnd.random() < 0.5 else str(rnd.integers(1, 5)) for w in re.findall(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+", text)]
    kept = [w for w in words if len(w) < 2 or rnd.random() > 0.06]
    around = ["".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 9))) for _ in range(rnd.integers(0, 5))]
    cut = rnd.integers(0, len(around) + 1)
    return " ".join([*around[:cut], "".join(kept), *around[cut:]])


def train(background: list[str], seed: int = 7, variants: int = 40, steps: int = 300) -> Model:
    """The model from varied templates and lines of background; lines much like a template aren't background."""
    rnd = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    grams = np.unique(_ngrams(*_lines([t for f in families for t in TEMPLATES[f]]))[0])
    lines, labels = [], []
    for number, family in enumerate(families):
        for template in TEMPLATES[family]:
            lines += [template, *(_varied(template, rnd) for _ in range(variants))]
            labels += [number] * (variants + 1)
    plain = [t for t in sorted(set(_pieces(background))) if best_template(t, None)[1] < 0.3]
    plain = [plain[k] for k in np.sort(rnd.permutation(len(plain))[:SAMPLE_LINES])]
    if plain:
        labels += labels
        lines += [_within(line, plain[rnd.integers(0, len(plain))], rnd) for line in lines]
    others = [t for t in NOT_TEMPLATES for _ in range(8)] + plain
    lines, labels = lines + others, np.array(labels + [len(families)] * len(others))
    model = Model(families, grams, np.zeros((len(grams), len(families) + 1)), np.zeros(len(families) + 1), 1.0)
    line, at, total = model.counts(*_lines(lines))
    x = np.zeros((len(lines), len(grams)), np.float32)
    np.add.at(x, (line, at), 1)
    x /= np.sqrt(np.maximum(total, 1))[:, None]
    wanted = np.eye(len(families) + 1)[labels]
    held = rnd.random(len(lines)) < 0.25
    xt, yt = x[~held], wanted[~held]
    # Classes weigh the same, so that unknown lines, which are most, don't take rare families.
    share = (yt / yt.sum(axis=0)).sum(axis=1)[:, None] / yt.shape[1]
    m, v = np.zeros((len(grams) + 1, yt.shape[1])), np.zeros((len(grams) + 1, yt.shape[1]))
    for step in range(1, steps + 1):
        z = xt @ model.weights + model.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = (z / z.sum(axis=1, keepdims=True) - yt) * share
        gradient = np.vstack([xt.T @ error + 1e-5 * model.weights, error.sum(axis=0)])
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        change = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        model.weights, model.bias = model.weights - change[:-1], model.bias - change[-1]
    logits = x[held] @ model.weights + model.bias
    losses = []
    for temperature in np.geomspace(0.2, 10, 40):
        model.temperature = float(temperature)
        losses.append((-np.log(np.maximum(1e-12, (model.probabilities(logits) * wanted[held]).sum(axis=1))).mean(), float(temperature)))
    model.temperature = min(losses)[1] if held.any() else 1.0
    return model


def _words(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _bigrams(text: str) -> set[tuple[str, ...]]:
    words = _words(text)
    return set(zip(words[:-1], words[1:], strict=True)) or {tuple(words)}


_TEMPLATE_BIGRAMS = [(family, _bigrams(t)) for family in sorted(TEMPLATES) for t in TEMPLATES[family]]


def best_template(line: str, family: str | None) -> tuple[str, float]:
    """The family, of one or all, with a template of which the line has the largest share of bigrams, and that share."""
    has = _bigrams(line)
    return max(((f, len(t & has) / len(t)) for f, t in _TEMPLATE_BIGRAMS if family in (None, f)), key=lambda x: x[1])


_LONGEST = max(len(pairs) for _, pairs in _TEMPLATE_BIGRAMS) + 1


@dataclass
class Notice:
    family: str
    probability: float
    similarity: float
    first: int  # word of the line, and the one after the last
    end: int


def _closest(words: list[str], free: list[bool], family: str, begin: int, end: int, probability: float) -> Notice:
    """The notice of a family in and beside words from ``begin`` to ``end``: those close to one another that have most of a template."""
    low, high = max(0, begin - _LONGEST), min(len(words), end + _LONGEST)
    best = (0.0, 0), Notice(family, probability, 0.0, begin, end)
    for pairs in (t for f, t in _TEMPLATE_BIGRAMS if f == family):
        at = [k for k in range(low, high - 1) if free[k] and free[k + 1] and (words[k], words[k + 1]) in pairs]
        reach = max(2 * len(pairs), WINDOW)
        for i, start in enumerate(at):
            has = set()
            for k in at[i:]:
                if k - start >= reach:
                    break
                has.add((words[k], words[k + 1]))
                if (rank := (len(has) / len(pairs), start - k)) > best[0]:
                    best = rank, Notice(family, probability, rank[0], start, k + 2)
    return best[1]


def line_notices(model: Model, words: list[str], windows: list[tuple[int, int, str, float]]) -> list[Notice]:
    """The notices in a line's words, from the windows (first word, end, family, probability) given to a family.

    The most similar counts first, and its words for no other, so that windows with a part of a notice don't add
    families, and a family is found as often as it has notices. What is left beside a confirmed notice is scored again by itself.
    Windows of a family that confirm none count as one where they overlap.
    """
    free, found, weak = [True] * len(words), [], []
    todo = [(w, False) for w in windows]
    while todo:
        near = [(_closest(words, free, family, begin, end, p), begin, end, again) for (begin, end, family, p), again in todo]
        near = sorted(near, key=lambda x: (-x[0].similarity, -x[0].probability, x[1]))
        best = near[0][0]
        if best.similarity < LEAST_CONTAINMENT:
            weak = [(x, begin, end) for x, begin, end, again in near if not again]
            break
        found.append(best)
        free[best.first : best.end] = [False] * (best.end - best.first)
        todo = [((begin, end, x.family, x.probability), again) for x, begin, end, again in near[1:] if all(free[begin:end]) or x.similarity >= LEAST_CONTAINMENT]
        for begin, end in ((max(0, best.first - WINDOW), best.first), (best.end, min(len(words), best.end + WINDOW))):
            while begin < end and not free[begin]:
                begin += 1
            while begin < end and not free[end - 1]:
                end -= 1
            kind, probability = model.score(*_lines([" ".join(words[begin:end])]))
            if kind[0] < len(model.families) and probability[0] >= LEAST_PROBABILITY:
                todo.append(((begin, end, model.families[kind[0]], float(probability[0])), True))
    for x, begin, end in weak:
        if all(free[begin:end]) and not any(y.family == x.family and y.first < x.end and x.first < y.end for y in found):
            found.append(x)
    return sorted(found, key=lambda x: (x.first, x.family))


def background_lines(df: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Lines of about ``SAMPLE_DOCUMENTS`` documents, those with the least hashes of their ids; ``SAMPLE_LINES`` at most.

    A line of more than 1,000 characters counts as that many lines of 1,000 and a rest.
    """
    total = df.count()
    order = F.xxhash64(F.lit("licence"), F.col(id_col).cast("string"))
    drawn = df if total <= SAMPLE_DOCUMENTS else df.where(order < F.lit(int(-(2**63) + SAMPLE_DOCUMENTS / total * 2**64)))
    line = drawn.select(F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line"))
    # Long lines are several: every part may be drawn.
    begin = F.sequence(F.lit(0), F.call_function("div", F.char_length("line"), F.lit(_PART)).cast("int"))
    part = F.transform(begin, lambda k: F.substring("line", k * _PART + 1, F.lit(_PART)))
    short = line.select(F.explode(part).alias("line")).where("line <> ''").distinct()
    return [r["line"] for r in short.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES).collect()]


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``licenses`` of every row: line (from 0), family, probability, similarity and whether confirmed,
    for all notices in the lines of the whole text, from the windows that the classifier gives to a family.

    Lines end at line feeds. Null and empty texts have none. Rows are independent but for the training sample,
    so repeated rows and null ids give a row each; other columns aren't read. An empty table gives an empty result.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    model = train(background_lines(source, "id", "text"))
    unknown = len(model.families)
    kind_type = pa.list_(pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_())]))

    def scan(raw: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
        ends = np.flatnonzero(raw == 10) + 1
        cuts = np.concatenate([offsets[:-1], ends])
        cuts.sort(kind="stable")
        bounds = np.append(cuts, len(raw))
        starts, ends, first = _spans(raw, bounds)
        line, begin, kind, probability = model.score_windows(span_hashes(raw, starts, ends, lower=True), first)
        hits = np.flatnonzero((kind != unknown) & (probability >= LEAST_PROBABILITY))
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        for k, windows in groupby(hits.tolist(), key=lambda h: int(line[h])):
            # Of texts that begin where this line does, all but the last are empty.
            text = int(np.searchsorted(offsets, bounds[k], side="right")) - 1
            number = k - int(np.searchsorted(cuts, offsets[text], side="right")) + 1
            words = [raw[a:b].tobytes().decode().lower() for a, b in zip(starts[first[k] : first[k + 1]].tolist(), ends[first[k] : first[k + 1]].tolist(), strict=True)]
            given = [(int(begin[h]), min(int(begin[h]) + WINDOW, len(words)), model.families[kind[h]], float(probability[h])) for h in windows]
            for x in line_notices(model, words, given):
                out[text].append({"line": number, "family": x.family, "probability": x.probability, "similarity": x.similarity, "confirmed": x.similarity >= LEAST_CONTAINMENT})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = flat_bytes(batch.column(1))
            found, at = [], 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _TEXT_BYTES, side="right")) - 1)
                found += scan(raw[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at])
                at = upto
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind_type)], names=["id", "licenses"])

    kind = "array<struct<line:bigint,family:string,probability:double,similarity:double,confirmed:boolean>>"
    return source.mapInArrow(tidy(run), f"id {source.schema['id'].dataType.simpleString()}, licenses {kind}").withColumnRenamed("id", id_col)
