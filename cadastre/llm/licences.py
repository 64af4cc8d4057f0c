"""Licence scan: a trained paragraph classifier, confirmed against templates.

Sparse word n-grams feed a multinomial logistic regression over licence families, a class of notices of
no known family and one of other text.  Its training rows come from the corpus: paragraphs that nearly
are a template are examples of its family, a bounded sample of the others are not.  Composed notices
and sentences that only use the words of licensing are added to both.

Thresholds are calibrated on held-out rows and on families left out: the model is fitted once more
without each family, whose notices must then be of no known family.  A paragraph is of a family if its
probability reaches the family's threshold; else ``unknown``, if the probability that it is no other text
reaches that of the unknown class; else nothing.  A family is confirmed by comparing the paragraph with
its templates.  Every line with a word is classified, and every block of such lines in which no line is
confirmed, so that a wrapped notice is read whole.

Lines and blocks of many texts are scored at once.  A null or empty text declares
nothing, and neither does a single word; a word of over 1 MiB is read as several; equal rows get equal results.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import fresh, ship
from cadastre.llm.words import text_bytes
from cadastre.sources.scratch import cut

# The notices by which licences are commonly declared, by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "Released under the BSD License",
    ],
    "cc": [
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-SA 4.0",
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
}
# Short names, by which a licence is also declared; to train on only, with text that begins alike.
NAMES = {
    "apache": ("Apache 2.0", "the Apache License 2.0", "the Apache-2.0 licence"),
    "bsd": ("BSD", "the BSD 3-Clause License", "the BSD 2-Clause licence"),
    "cc": ("CC BY 4.0", "CC BY-SA 4.0", "a Creative Commons licence"),
    "gpl": ("the GNU GPL v3", "the GPL v2", "the GPLv3", "the GNU General Public License"),
    "mit": ("MIT", "the MIT License", "the MIT licence"),
    "mpl": ("the MPL 2.0", "MPL-2.0", "the Mozilla Public License"),
}
OPENINGS = ("Distributed under", "Available under", "Released under", "This file is under the terms of", "Licensed under")
MARKS = ("Terms:", "License:", "SPDX-License-Identifier:", "It may be used under")
ELSE = (
    "the counter", "the name of", "this address", "his own name", "the agreement", "the bridge", "a new title", "the old tree",
    "these conditions", "the stairs", "pressure", "the watch of a guard", "new management", "her maiden name", "the sun",
    "the supervision of a doctor", "a white flag", "the table", "the influence of his brother", "arrest", "the ground",
)
# The same for licences of no family above, and sentences in which the words of licensing declare nothing.
FURTHER = (
    "EPL-2.0", "the Eclipse Public License 2.0", "the ISC License", "ISC", "zlib", "the zlib license", "BSL-1.0",
    "the Boost Software License 1.0", "the Artistic License 2.0", "CDDL-1.0", "EUPL-1.2", "the European Union Public Licence",
    "the Common Development and Distribution License", "the Unlicense", "WTFPL", "OFL-1.1", "the SIL Open Font License",
    "the PostgreSQL License", "the Python Software Foundation License", "MS-PL", "the Microsoft Public License", "AFL-3.0",
    "the Academic Free License", "the Open Software License", "a commercial licence", "a proprietary license",
)
NOTICES = (
    "All rights reserved", "All rights reserved by the authors", "Copyright 2019 the authors. All rights reserved.",
    "Copyright (c) 2020 by the company", "SPDX-License-Identifier: ISC", "License: EPL-1.0", "Licence: see the file COPYING",
    "Terms: zlib", "Permission to use, copy, modify, and distribute this software for any purpose is hereby granted",
    "This software is provided as is, without any express or implied warranty", "No warranty of any kind is given",
    "Anyone is free to copy, modify, publish, use, sell, or distribute this software for any purpose",
    "This work has been released into the public domain", "Dedicated to the public domain by its authors",
    "Unauthorised copying of this file is strictly prohibited", "This code is free to use for any purpose",
    "Use of this source code is governed by a licence that is in the LICENSE file", "See the LICENSE file for the terms of use",
)
PLAIN = (
    "The driver lost his licence last year", "Her fishing licence costs ten pounds", "The bar was refused a licence to sell wine",
    "They had a license to drill for oil", "He was licensed to carry passengers", "A dispute about copyright went to court",
    "She often spoke in the public domain", "Poets take liberties and call it license", "The doctor was licensed in two states",
    "The licence fee for television has risen", "The minister said that the matter was in the public domain",
    "A marriage licence was found in the drawer", "All seats are reserved for guests", "The licence plate of the car was broken",
    "The painter took some license with the colours", "His pilot licence was renewed", "Copyright is a subject of many lectures",
    "The software was sold to another company", "They had permission to use the road for any purpose",
)
FAMILIES = tuple(sorted(TEMPLATES))
UNKNOWN, OTHER = len(FAMILIES), len(FAMILIES) + 1
CLASSES = (*FAMILIES, "unknown", None)
GRAMS = 3
BUCKETS = 1 << 14
MAX_POSITIVE, MAX_OTHER = 1_000, 2_000  # training paragraphs: per family; of other text
SIMILAR, APART = 0.8, 0.5  # containment of word pairs: to train on and to confirm; at most, of other text
STEPS, RATE, RIDGE = 150, 0.1, 1e-4
OTHERS = 2.0
PRECISION, PRECISION_UNKNOWN = 0.99, 0.95  # on held-out rows, by which the thresholds are set
SLICE, STRETCH, GROUP = 1 << 20, 1 << 16, 1 << 21  # bytes hashed, words scored and bytes of texts read at once

_SPACE = b" \t\n\v\f\r"
_SIGNS = b".,;:!?\"'()[]<>*/#-"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLAIN = np.array([48 if 48 <= b < 58 else b + 32 if 65 <= b < 91 else b for b in range(256)], "u1")
_BREAK, _EDGE = (np.isin(np.arange(256), list(x)) for x in (_SPACE, _SPACE + _SIGNS))


def _powers(of: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, "u8"), np.full(SLICE, of, "u8")]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


_VALUE = _mixed(np.arange(1, 257, dtype="u8"))
_POWER, _INVERSE = _powers(int(_MIX)), _powers(pow(int(_MIX), -1, 1 << 64))


def words(paragraph: bytes) -> list[bytes]:
    """Lower-case words without the signs around them; numbers as 0, since versions vary."""
    plain = re.sub(rb"[0-9]+", b"0", paragraph.lower())
    return [w for w in (w.strip(_SIGNS) for w in plain.split()) if w]


def _hashed(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the words of bytes, as ``words`` gives them, cut at the places ``cuts`` too."""
    inside, fresh = ~_BREAK[data], np.zeros(len(data) + 1, bool)
    fresh[cuts], fresh[0], fresh[-1] = True, True, True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | fresh[1:-1]
    last[:-1] &= ~inside[1:] | fresh[1:-1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    firm = ~_EDGE[data]
    upto, firm = np.cumsum(firm), np.flatnonzero(firm)
    low, high = upto[first] - ~_EDGE[data[first]], upto[last] - 1
    first, last = firm[low[low <= high]], firm[high[low <= high]]
    plain = _PLAIN[data]
    digit = plain == 48
    kept = np.ones(len(data), bool)
    kept[1:] = ~(digit[1:] & digit[:-1]) | fresh[1:-1]
    place = np.cumsum(kept) - 1
    terms = np.append(np.where(kept, _VALUE[plain] * _POWER[place], np.uint64(0)), np.uint64(0))
    borders = np.stack([first, last + 1], axis=1).ravel()
    sums = np.add.reduceat(terms, borders)[::2] if len(first) else np.zeros(0, "u8")
    return _mixed(sums * _INVERSE[place[first]]), first


def hashed_words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of all words of the texts that begin at ``begins``, a slice at a time."""
    found, low = [(np.zeros(0, "u8"), np.zeros(0, "i8"))], 0
    while low < len(data):
        high = min(low + SLICE, len(data))
        gaps = np.flatnonzero(_BREAK[data[low:high]]) if high < len(data) else ()
        high = low + int(gaps[-1]) + 1 if len(gaps) else high
        cuts = begins[np.searchsorted(begins, low) : np.searchsorted(begins, high)] - low
        hashes, first = _hashed(data[low:high], cuts)
        found.append((hashes, first + low))
        low = high
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n words from each word on)."""
    run = np.zeros(len(hashes), "u8")
    for n in range(1, min(GRAMS, len(hashes)) + 1):
        run = _mixed(run[: len(hashes) - n + 1] ^ hashes[n - 1 :])
        yield n, run


def _different(hashes: np.ndarray, buckets: int) -> np.ndarray:
    runs = [(run % np.uint64(buckets)).astype("i8") for _, run in _runs(hashes)]
    return np.unique(np.concatenate([np.zeros(0, "i8"), *runs]))


def grams(paragraph: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the different n-grams of a paragraph."""
    return _different(hashed_words(np.frombuffer(paragraph, "u1"), np.zeros(1, "i8"))[0], buckets)


def _pairs(tokens: list[bytes]) -> set:
    return set(zip(tokens, tokens[1:])) or set(tokens)


_templates = {f: [_pairs(words(t.encode())) for t in TEMPLATES[f]] for f in FAMILIES}


def similarity(tokens: list[bytes], family: int) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    have = _pairs(tokens) | set(tokens)
    return max(len(t & have) / len(t) for t in _templates[FAMILIES[family]])


def _pair_hashes() -> np.ndarray:
    """Hashes of all word pairs of the templates."""
    every = [hashed_words(np.frombuffer(t.encode(), "u1"), np.zeros(1, "i8"))[0] for f in FAMILIES for t in TEMPLATES[f]]
    return np.unique(np.concatenate([dict(_runs(h))[2] for h in every]))


_template_pairs = _pair_hashes()
_least_pairs = min(-(-len(t) // 2) for f in FAMILIES for t in _templates[f])  # at APART of a template


class Paragraphs:
    """Lines with a word of many texts, blocks of such lines that adjoin, and the hashes of their words."""

    def __init__(self, texts: pa.Array):
        data, begins = text_bytes(texts)
        self.data = data
        breaks = np.flatnonzero(data == 10)
        of_break = np.searchsorted(begins, breaks, "right") - 1
        text = np.concatenate([np.arange(len(texts)), of_break])
        start = np.concatenate([begins[:-1], breaks + 1])
        order = np.lexsort((start, text))
        text, start = text[order], start[order]
        self.hashes, place = hashed_words(data, begins)
        line = np.searchsorted(start, place, "right") - 1
        filled = np.bincount(line, minlength=len(start)) > 0
        end = np.append(start[1:], len(data))
        end = np.where(np.append(text[1:] == text[:-1], np.zeros(min(1, len(text)), bool)), end - 1, begins[1:][text])
        number = np.arange(len(text)) - np.searchsorted(text, text)
        begun = filled.copy()
        begun[1:] &= ~filled[:-1] | (text[1:] != text[:-1])
        self.line = np.cumsum(filled)[line] - 1  # of each word
        self.block = np.cumsum(begun)[filled] - 1  # of each line
        self.text, self.start, self.end, self.number = text[filled], start[filled], end[filled], number[filled]
        self.first = np.flatnonzero(begun[filled])  # line of each block
        self.lines = np.diff(np.append(self.first, len(self.text)))  # of each block

    def body(self, low: int, high: int) -> bytes:
        """Bytes from one line to another, inclusive."""
        return self.data[self.start[low] : self.end[high]].tobytes()

    def template_pairs(self) -> np.ndarray:
        """Occurrences of word pairs of any template in each line."""
        out = np.zeros(len(self.text), "i8")
        for low in range(0, len(self.line), STRETCH):
            run = dict(_runs(self.hashes[low : low + STRETCH + 1])).get(2, self.hashes[:0])
            line = self.line[low : low + len(run) + 1]
            at = np.minimum(np.searchsorted(_template_pairs, run), len(_template_pairs) - 1)
            hit = (_template_pairs[at] == run) & (line[:-1] == line[1:])
            np.add.at(out, line[:-1][hit], 1)
        return out

    def sums(self, unit: np.ndarray, size: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sums of the weights, number) of the different n-grams of each of ``size`` units.

        ``unit`` numbers the unit of each word in order, -1 for words that count for none.  What a unit of over
        ``STRETCH`` words holds in several stretches counts in each.
        """
        sums, counts = np.zeros((size, weights.shape[1])), np.zeros(size, "i8")
        used = np.flatnonzero(unit >= 0)
        hashes, unit = (self.hashes, unit) if len(used) == len(unit) else (self.hashes[used], unit[used])
        width = np.uint64(len(weights))
        for low in range(0, len(unit), STRETCH):
            part, of = (x[low : low + STRETCH + GRAMS - 1] for x in (hashes, unit))
            m, found = min(STRETCH, len(unit) - low), []
            for n, run in _runs(part):
                k = min(m, len(run))
                same = of[:k] == of[n - 1 : n - 1 + k]
                found.append((of[:k].astype("u8") * width + run[:k] % width)[same])
            keys = np.concatenate(found)
            keys.sort()
            keys = keys[np.append(True, keys[1:] != keys[:-1])]
            of = (keys // width).astype("i8")
            here = np.flatnonzero(np.diff(of, prepend=-1))
            sums[of[here]] += np.add.reduceat(weights[(keys % width).astype("i8")], here, axis=0)
            counts[of[here]] += np.diff(np.append(here, len(of)))
        return sums, counts


@dataclass(frozen=True)
class LicenceModel:
    weights: np.ndarray  # buckets x classes
    bias: np.ndarray
    thresholds: np.ndarray  # per family, and of the unknown class

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.bias + sums / np.sqrt(np.maximum(1, counts))[:, None]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def verdicts(self, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, probability) of each row; a single word declares nothing."""
        p = self.probabilities(sums, counts)
        family = p[:, :UNKNOWN].argmax(axis=1)
        best = p[np.arange(len(p)), family]
        sure = (p.argmax(axis=1) == family) & (best >= self.thresholds[family])
        some = 1 - p[:, OTHER]
        rest = np.where(some >= self.thresholds[UNKNOWN], UNKNOWN, OTHER)
        return np.where(counts < 2, OTHER, np.where(sure, family, rest)), np.where(sure, best, some)


def _weights(rows: list, classes: np.ndarray, buckets: int, steps: int) -> LicenceModel:
    """Multinomial logistic regression by gradient steps; classes weigh alike, other text ``OTHERS`` times as much."""
    n = OTHER + 1
    row = np.repeat(np.arange(len(rows)), [len(k) for k in rows])
    used, key = np.unique(np.concatenate([np.zeros(0, "i8"), *rows]), return_inverse=True)
    val = np.repeat([1 / np.sqrt(max(1, len(k))) for k in rows], [len(k) for k in rows])
    truth = np.eye(n)[classes]
    share = truth / np.maximum(truth.sum(axis=0), 1) / max(1, len(np.unique(classes)))
    share[:, OTHER] *= OTHERS
    share = share.sum(axis=1, keepdims=True)
    w, b = np.zeros((len(used), n)), np.zeros(n)
    m, v = np.zeros((len(used) + 1, n)), np.zeros((len(used) + 1, n))
    for step in range(1, steps + 1):
        z = np.stack([np.bincount(row, val * w[:, c][key], minlength=len(rows)) for c in range(n)], axis=1) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - truth) * share
        g_w = np.stack([np.bincount(key, val * g[:, c][row], minlength=len(used)) for c in range(n)], axis=1) + RIDGE * w
        g = np.concatenate([g_w, g.sum(axis=0)[None, :]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = np.zeros((buckets, n))
    weights[used] = w
    return LicenceModel(weights, b, np.full(OTHER, 0.5))


def _predicted(model: LicenceModel, rows: list) -> np.ndarray:
    sums = np.array([model.weights[k].sum(axis=0) for k in rows]).reshape(-1, OTHER + 1)
    return model.probabilities(sums, np.array([len(k) for k in rows], "i8"))


def fit(rows: list, classes: np.ndarray, held: np.ndarray, buckets: int = BUCKETS) -> LicenceModel:
    """The model of the rows that are not ``held``; thresholds from those, and from each family left out in turn.

    A fit without a family sees a quarter of the other text and fewer steps; it only serves to calibrate.
    """
    pick = lambda at: [rows[i] for i in at]
    seen, kept = np.flatnonzero(~held), np.flatnonzero(held)
    model = _weights(pick(seen), classes[seen], buckets, STEPS)
    p, truth = [_predicted(model, pick(kept))], [classes[kept]]
    few = seen[(classes[seen] != OTHER) | (np.arange(len(seen)) % 4 == 0)]
    for f in range(UNKNOWN):
        use, out = few[classes[few] != f], np.flatnonzero(classes == f)[:MAX_OTHER // 5]
        without = _weights(pick(use), classes[use], buckets, STEPS // 3)
        ask = np.concatenate([out, kept[classes[kept] == OTHER]])
        p.append(_predicted(without, pick(ask)))
        truth.append(np.where(classes[ask] == f, UNKNOWN, OTHER))
    p, truth = np.concatenate(p), np.concatenate(truth)
    bars = [_threshold(p[:, f], truth == f) for f in range(UNKNOWN)] + [_threshold(1 - p[:, OTHER], truth != OTHER, PRECISION_UNKNOWN)]
    return LicenceModel(model.weights, model.bias, np.array(bars))


def _threshold(p: np.ndarray, right: np.ndarray, precision: float = PRECISION) -> float:
    """The lowest probability, 0.5 at least, from which on the predictions are precise enough."""
    order = np.argsort(-p, kind="stable")
    precise = np.cumsum(right[order]) / np.arange(1, len(p) + 1)
    good = np.flatnonzero((precise >= precision) & right[order])
    return max(0.5, float(p[order][good[-1]]) * 0.9) if len(good) else 0.5


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about ``GROUP`` bytes, or of one text that is longer."""
    low, size = 0, 0
    for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if i > low and size + n > GROUP:
            yield texts.slice(low, i - low)
            low, size = i, 0
        size += n
    if len(texts) > low:
        yield texts.slice(low)


def _examples(batches, buckets: int, most: int, others: int) -> Iterator[pa.RecordBatch]:
    """Of the lines of one task: those with the smallest hashes of each class, ``most`` or ``others`` at most.

    What is smallest of all is smallest in its task, so nothing is lost.  Lines travel as their n-grams.
    """
    least = [{} for _ in range(OTHER + 1)]  # hash: n-grams
    last = [[] for _ in least]  # heaps of the hashes, negated
    for batch in batches:
        for texts in _groups(batch.column(0)):
            lines = Paragraphs(texts)
            pairs = lines.template_pairs() >= _least_pairs
            begins = np.searchsorted(lines.line, np.arange(len(lines.text) + 1)).tolist()
            for i, alike in enumerate(pairs.tolist()):
                body = lines.body(i, i)
                family = OTHER
                if alike:
                    near = [similarity(words(body), f) for f in range(UNKNOWN)]
                    best = int(np.argmax(near))
                    if near[best] >= APART and near[best] < SIMILAR:
                        continue
                    family = best if near[best] >= SIMILAR else OTHER
                h, room = xxhash.xxh64_intdigest(body) >> 1, others if family == OTHER else most
                heap = last[family]
                if h in least[family] or (len(heap) >= room and h > -heap[0]):
                    continue
                least[family][h] = _different(lines.hashes[begins[i] : begins[i + 1]], buckets)
                heapq.heappush(heap, -h)
                if len(heap) > room:
                    del least[family][-heapq.heappop(heap)]
    for family, found in enumerate(least):
        for low in range(0, len(found), 256):
            part = list(found.items())[low : low + 256]
            arrays = [
                pa.array([family] * len(part), pa.int32()), pa.array([h for h, _ in part], pa.int64()),
                pa.array([x.astype("<u4").tobytes() for _, x in part], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["family", "h", "keys"])


def train(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> LicenceModel:
    """Fit on paragraphs of the corpus, on the templates and on composed notices and sentences.

    Candidates are the different lines; the driver receives the n-grams of ``MAX_POSITIVE`` of each
    family and ``MAX_OTHER`` others at most, those with the smallest hash.
    """
    ship(docs.sparkSession)
    most, others = MAX_POSITIVE, MAX_OTHER
    named = docs.select(F.col(text).alias("text")).mapInArrow(
        lambda batches: _examples(batches, buckets, most, others), "family int, h long, keys binary"
    )
    named = cut(named.groupBy("family", "h").agg(F.min("keys").alias("keys")))
    rows, classes = [], []
    for f in (*range(UNKNOWN), OTHER):
        for r in named.filter(F.col("family") == f).orderBy("h").limit(others if f == OTHER else most).collect():
            rows.append(np.frombuffer(r["keys"], "<u4").astype("i8"))
            classes.append(f)
    own = [(t, f) for f in range(UNKNOWN) for t in TEMPLATES[FAMILIES[f]]] + [(t, OTHER) for t in PLAIN]
    # As many of them as of names, which are composed with every opening.
    own += [(t, UNKNOWN) for a, b in zip(NOTICES, NOTICES[1:] + NOTICES) for t in (a, f"{a}. {b}", f"{b}; {a}")] * 4
    fixed = len(rows) + len(own)  # never held out
    own += [(f"{o} {n}", f) for f in range(UNKNOWN) for o in OPENINGS + MARKS for n in NAMES[FAMILIES[f]]]
    own += [(f"{o} {n}", UNKNOWN) for o in OPENINGS + MARKS for n in FURTHER]
    own += [(f"{o} {n}", OTHER) for o in OPENINGS for n in ELSE]
    place = np.arange(len(rows) + len(own))
    held = (place % 4 == 3) & ((place < len(rows)) | (place >= fixed))
    rows += [grams(t.encode(), buckets) for t, _ in own]
    return fit(rows, np.array(classes + [c for _, c in own], "i8"), held, buckets)


FOUND = "array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>"


def judge_all(texts: pa.Array, model: LicenceModel) -> list[list[dict]]:
    """What the paragraphs of each whole text declare; ``unknown`` for a licence of no known family.

    A paragraph is a line or, if no line of it is confirmed, the block of lines between those without words.
    The block is placed at its first line and stands for them if it is confirmed or they are of no known family.
    """
    out: list[list[dict]] = []
    for group in _groups(texts):
        found: list[list[dict]] = [[] for _ in range(len(group))]
        lines = Paragraphs(group)
        block = np.where(lines.lines > 1, np.arange(len(lines.lines)), -1)[lines.block][lines.line]  # of each word
        units = (lines.line, len(lines.text)), (block, len(lines.first))
        of_line, of_block = (model.verdicts(*lines.sums(*x, model.weights)) for x in units)
        hit = (of_block[0] != OTHER) & (lines.lines > 1)
        hit[lines.block[of_line[0] != OTHER]] = True

        def named(verdict, at: int, low: int, high: int) -> list[tuple[int, dict]]:
            c, p = int(verdict[0][at]), float(verdict[1][at])
            if c == OTHER:
                return []
            alike = 0.0 if c == UNKNOWN else similarity(words(lines.body(low, high)), c)
            declared = {"family": CLASSES[c], "probability": p, "similarity": alike, "confirmed": alike >= SIMILAR}
            return [(int(lines.number[low]), declared)]

        for b in np.flatnonzero(hit).tolist():
            low, n = int(lines.first[b]), int(lines.lines[b])
            each = [x for i in range(low, low + n) for x in named(of_line, i, i, i)]
            if n > 1 and not any(x["confirmed"] for _, x in each):
                whole = named(of_block, b, low, low + n - 1)
                if whole and (whole[0][1]["confirmed"] or all(x["family"] == "unknown" for _, x in each)):
                    each = whole
            found[lines.text[low]] += [{"paragraph": k, **x} for k, x in each]
        out += found
    return out


def judge(text: str | None, model: LicenceModel) -> list[dict]:
    """``judge_all`` of one text."""
    return judge_all(pa.array([text], pa.large_string()), model)[0]


def scan(docs: DataFrame, model: LicenceModel, text: str = "text", name: str = "licences") -> DataFrame:
    """The rows of ``docs`` with a column more: the licence paragraphs of each whole text."""
    spark, name = docs.sparkSession, fresh(docs, name)
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # of fixed size

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(judge_all(pa.array(texts, pa.large_string()), sent.value))

    return docs.withColumn(name, found(F.col(text)))
