"""License scans by a paragraph classifier.

A paragraph is a run of lines with words; marks of comments are no words, so a commented notice reads
like any other. It is scored line by line, and in windows of ``WINDOW`` words across its lines, so that
a notice is found wrapped, within a long line or beside other text. Words and pairs of words are hashed into features of a multinomial
logistic regression over licence families and "unknown". It is trained on templates with words left
out, replaced and added, and on paragraphs of a bounded sample of the documents as unknown. Held-out
examples calibrate it: a temperature for its probabilities, and the least probability at which a
licence is believed. A believed line or window is confirmed by comparison with the templates around it: the words must hold most
pairs of one of them close together; the family is that of the template that is held best.

Scale. One pass over the texts without a shuffle; features and scores of a batch of texts are array
operations. Training reads about ``MAX_ROWS`` documents, a parameter, and is one small task.

Defined results: null and empty texts have no paragraphs; equal texts have equal results; without
documents the unknown class has only written examples. Other columns pass through untouched;
beside one called like the result, the result has an underscore in front.
"""

from __future__ import annotations

import pickle
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import NOT_ALPHANUMERIC, in_chunks, mix, spare_name, words_in

# Documents whose paragraphs are examples of the unknown class, about; paragraphs of each.
MAX_ROWS = 1000
PARAGRAPHS_EACH = 4
VARIANTS = 30
FEATURES = 1 << 13
ROUNDS = 120
RATE = 0.5
DECAY = 1e-5
# Share of believed held-out examples that must be right, and of a template's pairs to be found.
PRECISION = 0.995
CONFIRMED = 0.7
# Words of a training example from a document.
EXAMPLE_WORDS = 60
# Words of a window, and from one window to the next.
WINDOW = 24
STRIDE = 8

UNKNOWN = "unknown"

# Notices by family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "public-domain": [
        "This work has been released into the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 Example Inc. All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}
# Sentences near the subject that name no licence.
NO_LICENCE = [
    "She renewed her driving license in March.",
    "The license plate of the car was found.",
    "All rights belong to the people, he said.",
    "The public library is free to all.",
    "He was licensed to practise medicine in the state.",
    "The committee reserved the rooms for the general meeting.",
    "A new version of the software was released under the old name.",
    "The copyright office is open on weekdays.",
]
FAMILIES = [*sorted(TEMPLATES), UNKNOWN]
_FILLERS = "the of and to in for on with this file project work code text see more about our site page".split()


def paragraphs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line, first, end) of every line with a word; first and end count words of all texts."""
    words = words_in(texts, NOT_ALPHANUMERIC)
    if not len(words.hashes):
        return (*[np.empty(0, np.int64)] * 3, words.hashes)
    lines = np.cumsum(words.data == 10)[words.starts]
    text = np.searchsorted(words.bounds, np.arange(len(lines)), side="right") - 1
    first = np.flatnonzero(np.diff(lines * 1.0 + text, prepend=-1.0) != 0)
    before = np.concatenate(([0], np.cumsum(words.data == 10)))[words.offsets[:-1]]
    return text[first], lines[first] - before[text[first]], first, words.hashes


def _features(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every word and of the pair it ends; a paragraph's first word ends none."""
    single = (hashes % np.uint64(FEATURES)).astype(np.int64)
    pair = hashes.copy()
    pair[1:] += hashes[:-1] * np.uint64(0xD6E8FEB86659FD93)
    pair = (mix(pair) % np.uint64(FEATURES)).astype(np.int64)
    # A first word stands for its pair once more, so that every word has two features.
    pair[first] = single[first]
    return single, pair


def logits(weights: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Scores (paragraph, family) from sums of weights, divided by the root of the number of features."""
    single, pair = _features(hashes, first)
    sums = np.add.reduceat(weights[single] + weights[pair], first, axis=0)
    counts = np.diff(np.append(first, len(hashes)))
    return sums / np.sqrt(2 * counts)[:, None] + weights[FEATURES]


@dataclass
class Model:
    weights: np.ndarray
    temperature: float
    least: float

    def believed(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Family of every paragraph, -1 if it is unknown, and its probability."""
        return self.of_scores(logits(self.weights, hashes, first))

    def of_scores(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest family and the probability of any; the templates tell near families apart."""
        shares = _softmax(scores / self.temperature)
        top = 1 - shares[:, -1]
        return np.where(top >= self.least, shares[:, :-1].argmax(axis=1), -1), top


def _softmax(scores: np.ndarray) -> np.ndarray:
    power = np.exp(scores - scores.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def _variant(pick: random.Random, text: str, others: list[str]) -> str:
    """A template with some words left out or replaced, and others around it."""
    words = [w for w in text.split() if pick.random() > 0.06]
    words = [pick.choice(_FILLERS) if pick.random() < 0.04 else w for w in words]
    around = pick.choice(others).split()
    cut = pick.randint(0, min(8, len(around)))
    kind = pick.randint(0, 3)
    if len(words) > WINDOW and pick.random() < 0.5:
        # What a window sees of a long notice.
        begin = pick.randint(0, len(words) - WINDOW)
        return " ".join(words[begin : begin + WINDOW])
    if len(words) < WINDOW and pick.random() < 0.4:
        # A short notice within other text.
        ahead = pick.randint(0, WINDOW - len(words))
        while len(around) < WINDOW:
            around += pick.choice(others).split() or _FILLERS
        return " ".join(around[:ahead] + words + around[ahead : WINDOW - len(words)])
    return " ".join(around[:cut] + words if kind == 1 else words + around[:cut] if kind == 2 else words)


def _some_words(pick: random.Random, text: str) -> str:
    """Words in a row of a paragraph, from anywhere in it."""
    words = text.split()
    begin = pick.randint(0, max(0, len(words) - EXAMPLE_WORDS))
    return " ".join(words[begin : begin + EXAMPLE_WORDS])


def train(found: list[str], seed: int = 3) -> Model:
    """A model from the templates and from paragraphs of documents, those near a template left out."""
    pick = random.Random(seed)
    others = [p for p in found if all(_held(p, t) < 0.5 for ts in TEMPLATES.values() for t in ts)]
    others = [_some_words(pick, p) for p in others] or NO_LICENCE
    texts, labels = [], []
    for family, templates in TEMPLATES.items():
        for template in templates:
            for _ in range(VARIANTS):
                texts.append(_variant(pick, template, others))
                labels.append(FAMILIES.index(family))
    unknown = others + [_variant(pick, t, others) for t in NO_LICENCE for _ in range(VARIANTS)]
    texts += unknown
    labels += [len(FAMILIES) - 1] * len(unknown)
    kept = [i for i, text in enumerate(texts) if words_in([text.encode()], NOT_ALPHANUMERIC).hashes.size]
    pick.shuffle(kept)
    calibrating, learning = kept[: len(kept) // 5], kept[len(kept) // 5 :]
    truth = np.array(labels)

    def arrays(chosen: list[int]) -> tuple[np.ndarray, np.ndarray]:
        _, _, first, hashes = paragraphs([texts[i].replace("\n", " ").encode() for i in chosen])
        return hashes, first

    weights = np.zeros((FEATURES + 1, len(FAMILIES)), np.float64)
    squares = np.full(weights.shape, 1e-6)
    hashes, first = arrays(learning)
    single, pair = _features(hashes, first)
    counts = np.diff(np.append(first, len(hashes)))
    hot = np.eye(len(FAMILIES))[truth[learning]]
    for _ in range(ROUNDS):
        error = (_softmax(logits(weights, hashes, first)) - hot) / len(learning)
        spread = np.repeat(error / np.sqrt(2 * counts)[:, None], counts, axis=0)
        gradient = DECAY * weights
        np.add.at(gradient, single, spread)
        np.add.at(gradient, pair, spread)
        gradient[FEATURES] = error.sum(axis=0)
        squares += gradient**2
        weights -= RATE * gradient / np.sqrt(squares)
    return _calibrated(weights, *arrays(calibrating), truth[calibrating])


def _calibrated(weights: np.ndarray, hashes: np.ndarray, first: np.ndarray, truth: np.ndarray) -> Model:
    """Temperature of the least loss, then the least probability of a licence that is right often enough."""
    scores = logits(weights, hashes, first)
    rows = np.arange(len(truth))
    losses = {
        t: -np.log(_softmax(scores / t)[rows, truth] + 1e-12).mean() for t in np.geomspace(0.25, 4, 17)
    }
    temperature = float(min(losses, key=losses.get))
    top = 1 - _softmax(scores / temperature)[:, -1]
    right = truth < len(FAMILIES) - 1
    order = np.argsort(-top)
    precise = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * np.arange(1, len(order) + 1))
    least = float(top[order][precise[-1]]) if len(precise) else 1.0
    return Model(weights.astype(np.float32), temperature, max(0.5, least))


def _pairs(text: str) -> set:
    hashes = words_in([text.encode("utf-8", "surrogatepass")], NOT_ALPHANUMERIC).hashes.tolist()
    return set(zip(hashes, hashes[1:])) or set(hashes)


_TEMPLATE_PAIRS = {t: _pairs(t) for templates in TEMPLATES.values() for t in templates}
_LONGEST = max(map(len, _TEMPLATE_PAIRS.values())) + WINDOW


def _held(text: str, template: str) -> float:
    wanted = _TEMPLATE_PAIRS[template]
    return len(wanted & _pairs(text)) / len(wanted)


def _first_paragraphs(texts: pa.Array) -> pa.Array:
    found = []
    for text in texts.to_pylist():
        lines = [line for line in (text or "").split("\n") if line.strip()]
        found.append(random.Random(len(lines)).sample(lines, min(PARAGRAPHS_EACH, len(lines))))
    return pa.array(found, pa.list_(pa.string()))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.column(0).to_pylist()]
    model = train(sorted({line for row in rows for line in row}))
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})


def fit(
    documents: DataFrame, id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS
) -> Model:
    """A model whose unknown class has paragraphs of about ``max_rows`` documents, chosen by a hash."""
    share = min(1.0, max_rows / max(1, documents.count()))
    whole = F.col(f"`{text}`")
    place = F.pmod(F.xxhash64(F.col(f"`{id}`"), whole), F.lit(1 << 32))
    lines = documents.where(place < int(share * (1 << 32))).select(
        F.arrow_udf(_first_paragraphs, "array<string>")(whole).alias("lines")
    )
    # An empty table still has one row to learn from.
    none = documents.sparkSession.range(1).select(F.array().cast("array<string>"))
    [[model]] = lines.union(none).repartition(1).mapInArrow(_trained, "model binary").collect()
    return pickle.loads(model)


RESULT = (
    "struct<n_paragraphs: bigint, found: array<struct<family: string, line: bigint, "
    "probability: double, template: double>>>"
)
_ARROW = pa.struct(
    [
        ("n_paragraphs", pa.int64()),
        (
            "found",
            pa.list_(
                pa.struct(
                    [("family", pa.string()), ("line", pa.int64()), ("probability", pa.float64()), ("template", pa.float64())]
                )
            ),
        ),
    ]
)


def _windows(model: Model, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Believed windows of the paragraphs ``starts`` to ``ends``: first and end word, and probability."""
    counts = np.where(ends - starts > 3, -(-np.maximum(ends - starts - WINDOW, 0) // STRIDE) + 1, 0)
    paragraph = np.repeat(np.arange(len(starts)), counts)
    number = np.arange(len(paragraph)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[paragraph] + number * STRIDE
    end = np.minimum(first + WINDOW, ends[paragraph])
    single, pair = _features(hashes, starts)
    sums = np.zeros((len(hashes) + 1, model.weights.shape[1]))
    np.cumsum(model.weights[single] + model.weights[pair], axis=0, out=sums[1:])
    scores = (sums[end] - sums[first]) / np.sqrt(2 * (end - first))[:, None] + model.weights[FEATURES]
    family, top = model.of_scores(scores)
    sure = family >= 0
    return first[sure], end[sure], top[sure], paragraph[sure]


def _best_template(hashes: list[int]) -> tuple[float, str, int, int]:
    """The template held best close together: its share, its family, and the words from first to last."""
    best = (0.0, "", 0, 0)
    pairs = list(zip(hashes, hashes[1:])) if len(hashes) > 1 else []
    for family, templates in TEMPLATES.items():
        for template in templates:
            wanted = _TEMPLATE_PAIRS[template]
            places = [i for i, pair in enumerate(pairs) if pair in wanted]
            reach = len(wanted) + len(wanted) // 3 + 4
            for k, begin in enumerate(places):
                near = [i for i in places[k : k + 2 * reach] if i - begin <= reach]
                share = len({pairs[i] for i in near}) / len(wanted)
                # Of templates held equally the longer one says more.
                if (share, len(near)) > (best[0], best[3] - best[2]):
                    best = (share, family, begin, near[-1] + 2)
                if share == 1:
                    break
    return best


def scan(model: Model, texts: list[bytes | None]) -> list[dict]:
    """Paragraphs, which are counted as lines with a word, and confirmed licences of each text."""
    results = [{"n_paragraphs": 0, "found": []} for _ in texts]
    text, line, first, hashes = paragraphs(texts)
    if not len(first):
        return results
    for number, count in zip(*(x.tolist() for x in np.unique(text, return_counts=True))):
        results[number]["n_paragraphs"] = count
    ends = np.append(first[1:], len(hashes))
    family, top = model.believed(hashes, first)
    taken: set[tuple[int, int]] = set()

    def confirm(begin: int, end: int, number: int, probability: float) -> None:
        held, name, at, stop = _best_template(hashes[begin:end].tolist())
        if held < CONFIRMED:
            return
        own = np.searchsorted(first, [begin + at, begin + stop - 1], side="right") - 1
        lines = {(number, int(line[i])) for i in range(own[0], own[1] + 1)}
        if not lines & taken:
            taken.update(lines)
            found = {"family": name, "line": int(line[own[0]]), "probability": probability, "template": held}
            results[number]["found"].append(found)

    for i in np.flatnonzero(family >= 0).tolist():
        confirm(int(first[i]), int(ends[i]), int(text[i]), float(top[i]))
    # Lines without one between them make a paragraph.
    breaks = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(line) != 1)))
    starts = first[breaks]
    stops = np.append(starts[1:], len(hashes))
    begins, window_ends, tops, of = _windows(model, hashes, starts, stops)
    at = 0
    while at < len(begins):
        upto = at + 1
        while upto < len(begins) and of[upto] == of[at] and begins[upto] <= window_ends[upto - 1]:
            upto += 1
        # Around the windows as far as the longest template may reach.
        begin = max(int(starts[of[at]]), int(begins[at]) - _LONGEST)
        end = min(int(stops[of[at]]), int(window_ends[upto - 1]) + _LONGEST)
        confirm(begin, end, int(text[breaks[of[at]]]), float(tops[at:upto].max()))
        at = upto
    for result in results:
        result["found"].sort(key=lambda found: found["line"])
    return results


def _scanned(model: Broadcast):
    def scanned(texts: pa.Array) -> pa.Array:
        results = []
        for chunk in in_chunks(texts.to_pylist()):
            results += scan(model.value, chunk)
        return pa.array(results, _ARROW)

    return scanned


def scanned(
    documents: DataFrame, model: Model, text: str = "text", result: str = "licences"
) -> DataFrame:
    """``documents`` with their number of paragraphs and the licences found in them."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    found = F.arrow_udf(_scanned(sent), RESULT)
    return documents.withColumn(spare_name(documents, result), found(F.col(f"`{text}`").cast("binary")))
