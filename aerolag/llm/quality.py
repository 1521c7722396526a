"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes numeric features; every feature is cut into bins. Shallow trees over the bins of
one feature are boosted in turn, feature by feature, round by round, each on what all others have
left unexplained; their sum is one lookup table per feature. Then the pairs of features that explain
most of the rest get two-way tables in the same manner. A score is the sum of the looked-up numbers
through the logistic function, so each feature's share of it can be read off.

Scale. Training reads at most about ``max_rows`` labelled rows, chosen by a hash of their id, whose
ids are broadcast; the bound is a parameter. Scoring is one pass over all texts without a shuffle:
features over the bytes of a batch of texts, then additions of table entries.

Defined results: null and empty texts have the features of an empty text and are scored; labels that
are null are not used; several labels of a document are all used; without labels of both classes the
score is their share of ones, or 0.5 without any; equal texts have equal scores. Other columns of
the documents pass through untouched; beside one called like the result, the result has an underscore
in front.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import SPACES, hashed_words, in_chunks, mix, spare_name

# Labelled rows to learn from, about.
MAX_ROWS = 20_000
# Every FOLDS-th of the hashed ids is held out.
FOLDS = 5
THRESHOLD = 0.3

BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
LEAVES = 4
# Newton steps are damped by this much weight, and a leaf holds at least this much.
RIDGE = 5.0
LEAF_WEIGHT = 2.0

FEATURES = [
    "log_bytes",
    "log_words",
    "upper",
    "digits",
    "blanks",
    "symbols",
    "marks",
    "exclamations",
    "stops_and_commas",
    "not_ascii",
    "log_lines",
    "bytes_per_word",
    "long_words",
    "short_words",
    "distinct_words",
    "distinct_pairs",
    "distinct_triples",
    "same_as_previous",
    "most_common_word",
    "words_per_line",
    "distinct_lines",
    "entropy",
]


def _bytes(letters: bytes) -> np.ndarray:
    return np.frombuffer(letters, np.uint8)


_UPPER = _bytes(bytes(range(65, 91)))
_DIGITS = _bytes(bytes(range(48, 58)))
_BLANKS = _bytes(b" \t\n\x0b\x0c\r")
_SYMBOLS = _bytes(b"#*$%&|<>")
_MARKS = _bytes(b"\"'()-/:;=@[\\]^_`{}~+?")


def _distinct(hashes: np.ndarray) -> float:
    return len(np.unique(hashes)) / len(hashes) if len(hashes) else 1.0


def _chained(words: np.ndarray, width: int) -> np.ndarray:
    count = max(0, len(words) - width + 1)
    found = words[:count].copy()
    for shift in range(1, width):
        found = found * np.uint64(0xD6E8FEB86659FD93) + words[shift : shift + count]
    return mix(found)


def _row(text: bytes, words: np.ndarray, lengths: np.ndarray) -> list[float]:
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = max(1, len(text)), max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    shares = counts[counts > 0] / size
    word_counts = np.unique(words, return_counts=True)[1]
    part = lambda chosen: counts[chosen].sum() / size
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        part(_UPPER),
        part(_DIGITS),
        part(_BLANKS),
        part(_SYMBOLS),
        part(_MARKS),
        counts[33] / size,
        (counts[44] + counts[46]) / n,
        counts[128:].sum() / size,
        np.log1p(len(lines)),
        lengths.sum() / n,
        (lengths > 12).sum() / n,
        (lengths < 4).sum() / n,
        len(word_counts) / n,
        _distinct(_chained(words, 2)),
        _distinct(_chained(words, 3)),
        (words[1:] == words[:-1]).sum() / n,
        word_counts.max(initial=0) / n,
        len(words) / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)),
        float(-(shares * np.log(shares)).sum()),
    ]


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row of FEATURES per text."""
    rows = []
    for chunk in in_chunks(texts):
        bounds, words, starts, offsets = hashed_words(chunk, SPACES)
        # A word's length runs to the next one or the end, less what separates them; nearly exact.
        ends = np.append(starts[1:], offsets[-1]) - 1
        for i, text in enumerate(chunk):
            own = slice(bounds[i], bounds[i + 1])
            stop = np.minimum(ends[own], offsets[i] + len(text or b""))
            rows.append(_row(text or b"", words[own], stop - starts[own]))
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins in two."""
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    g_all, w_all = gradient.sum(), weight.sum()
    gain = g**2 / (w + RIDGE) + (g_all - g) ** 2 / (w_all - w + RIDGE) - g_all**2 / (w_all + RIDGE)
    gain[(w < LEAF_WEIGHT) | (w_all - w < LEAF_WEIGHT)] = 0
    best = int(gain.argmax()) if len(gain) else 0
    return (float(gain[best]), best + 1) if len(gain) else (0.0, 0)


def tree_1d(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A step per bin, from a tree of at most LEAVES leaves that is grown best cut first."""
    parts = [(0, len(gradient))]
    while len(parts) < LEAVES:
        cuts = [(*_best_cut(gradient[a:b], weight[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 0:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    step = np.zeros(len(gradient))
    for a, b in parts:
        step[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + RIDGE)
    return step


def tree_2d(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts one feature once and the other once in each half."""
    best = (0.0, np.zeros_like(gradient))
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        for at in range(1, len(g)):
            step, gain = np.zeros_like(g), 0.0
            for half in (slice(0, at), slice(at, None)):
                line_g, line_w = g[half].sum(axis=0), w[half].sum(axis=0)
                more, cut = _best_cut(line_g, line_w)
                for side in (slice(0, cut), slice(cut, None)):
                    total = line_w[side].sum() + RIDGE
                    step[half, side] = line_g[side].sum() / total
                    gain += line_g[side].sum() ** 2 / total
            if gain > best[0]:
                best = (gain, step.T if turned else step)
    return best


@dataclass
class Model:
    """Lookup tables. ``edges`` cut features into bins; a bin i holds values up to edge i."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], rows[:, j])]
        coarse = [np.searchsorted(e, rows[:, j]) for j, e in enumerate(self.pair_edges)]
        for a, b, table in self.pairs:
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def train(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the tables of features in turn, then those of the pairs that explain most of the rest."""
    share = labels.mean() if len(labels) else 0.5
    if share in (0, 1) or not len(labels):
        # Without a second class there is nothing to learn.
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))))
    model = Model(float(np.log(share / (1 - share))))
    total = np.full(len(rows), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    model.edges = [_edges(rows[:, j], BINS) for j in range(rows.shape[1])]
    bins = [np.searchsorted(e, rows[:, j]) for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    for _ in range(ROUNDS):
        for at, table in zip(bins, model.tables):
            g, w = residual()
            sums = [np.bincount(at, x, minlength=len(table)) for x in (g, w)]
            step = RATE * tree_1d(*sums)
            table += step
            total += step[at]
    model.pair_edges = [_edges(rows[:, j], PAIR_BINS) for j in range(rows.shape[1])]
    coarse = [np.searchsorted(e, rows[:, j]) for j, e in enumerate(model.pair_edges)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        flat = np.bincount(coarse[a] * shape[1] + coarse[b], values, minlength=shape[0] * shape[1])
        return flat.reshape(shape)

    g, w = residual()
    gains = [
        (tree_2d(grid(a, b, g), grid(a, b, w))[0], a, b)
        for a in range(rows.shape[1])
        for b in range(a)
    ]
    model.pairs = [(a, b, np.zeros_like(grid(a, b, g))) for _, a, b in sorted(gains)[: -PAIRS - 1 : -1]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            g, w = residual()
            step = RATE * tree_2d(grid(a, b, g), grid(a, b, w))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(id: Column) -> Column:
    """Whether a document is kept from training: a fixed fifth of all ids."""
    text = F.coalesce(id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def _features_of(texts: pa.Array) -> pa.Array:
    rows = features(texts.to_pylist())
    return pa.array(list(rows), pa.list_(pa.float64()))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model of ``label`` from labelled documents that are not held out, about ``max_rows`` of them."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label")).where(
        F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    # A hash of the id in 2**32 steps decides, so that the same rows are chosen however they lie.
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(share * (1 << 32)))
    texts = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    found = (
        texts.join(F.broadcast(chosen), "id")
        .select("id", F.col("label").cast("double"), F.arrow_udf(_features_of, "array<double>")("text").alias("row"))
        .collect()
    )
    # In a fixed order, so that sums of floats come out the same each time.
    found.sort(key=lambda row: (row["id"], row["label"], row["row"]))
    rows = np.array([row["row"] for row in found]).reshape(-1, len(FEATURES))
    return train(rows, np.array([float(row["label"] > 0) for row in found]))


def _scored(model: Broadcast):
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.value.score(features(texts.to_pylist())))

    return scored


def scored(
    documents: DataFrame, model: Model, text: str = "text", result: str = "score"
) -> DataFrame:
    """``documents`` with their score, between 0 and 1."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    score = F.arrow_udf(_scored(sent), "double")
    return documents.withColumn(spare_name(documents, result), score(F.col(f"`{text}`").cast("binary")))
