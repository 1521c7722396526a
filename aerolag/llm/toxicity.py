"""Toxicity: a factorization machine over hashed terms.

The terms of a text are its words and the beginnings of its words, lower-cased and hashed into
``SLOTS`` slots; a term's value grows with the logarithm of its count. A score is a bias, a weight per
term and, for every pair of terms of the text, the product of their values and of their factor
vectors. So two terms that are harmless alone can be toxic together, and neither needs to have been
seen with the other: what one learns from its other partners carries over. The sum over all pairs
takes one pass: half of the squared sum of the vectors less the sum of their squares.

Scale. Training reads about ``max_rows`` labelled rows at most, chosen by a hash of their id; their
terms are counted in the tasks that read the texts, and one task fits them by AdaGrad in a fixed
order. Scoring is one pass over all texts without a shuffle. The model has a row per term that enough
of the examples hold, so its size is bounded by that of the sample.

Defined results: a null or empty text has no terms and the score of the bias; null labels are not
used, a label above zero is toxic; several labels of a document are all used; without labels of both
classes the score is their share of ones, or 0.5 without any; equal texts have equal scores; an empty
table has no rows. Other columns pass through; beside one called like the result, the result has an
underscore in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import NOT_ALPHANUMERIC, in_chunks, mix, spare_name, stored, words_in
from aerolag.llm.quality import held_out

# Labelled rows to learn from, about.
MAX_ROWS = 10_000
THRESHOLD = 0.5

SLOTS = 1 << 20
# Beginnings of words that are terms, by their bytes.
HEADS = (4, 5, 6)
# Examples that hold a term of the model at least.
LEAST_HOLDERS = 8
FACTORS = 8
STEPS = 1200
BATCH = 64
RATE = 0.2
DECAY = 2e-5
SEED = 13

MODEL = "slot array<int>, weight array<float>, factors array<float>, bias double"


def _slots(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text and slot of every term of the texts, with repetitions."""
    found = words_in(texts, NOT_ALPHANUMERIC)
    own = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
    size = found.ends - found.starts
    owners, hashes = [own], [found.hashes]
    head = np.zeros(len(own), np.uint64)
    at = 0
    for length in HEADS:
        longer = size >= length
        own, size, head = own[longer], size[longer], head[longer]
        starts = found.starts[: len(longer)][longer] if at == 0 else starts[longer]
        for place in range(at, length):
            head = head * np.uint64(257) + found.data[starts + place].astype(np.uint64) + np.uint64(1)
        at = length
        owners.append(own)
        hashes.append(mix(head + np.uint64(length << 56)))
    slots = np.concatenate(hashes) % np.uint64(SLOTS)
    return np.concatenate(owners), slots.astype(np.int64)


def terms(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, slot and value of the distinct terms, by text and slot."""
    owners, slots = _slots(texts)
    keys, counts = np.unique(owners * SLOTS + slots, return_counts=True)
    return keys // SLOTS, keys % SLOTS, np.log1p(counts).astype(np.float32)


@dataclass
class Model:
    """``row_of`` gives the row of a slot in ``weights`` and ``factors``; -1 means no such term."""

    bias: float
    row_of: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        scores = []
        for chunk in in_chunks(texts):
            owners, slots = _slots(chunk)
            rows = self.row_of[slots]
            known = rows >= 0
            width = max(1, len(self.weights))
            keys, counts = np.unique(owners[known] * width + rows[known], return_counts=True)
            scores.append(self.margins(keys // width, keys % width, np.log1p(counts), len(chunk)))
        total = np.concatenate(scores) if scores else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def margins(self, owners: np.ndarray, rows: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
        """The sum of bias, weights and pairs for each text."""
        values = values / _norms(owners, values, texts)[owners]
        total = self.bias + np.bincount(owners, self.weights[rows] * values, texts)
        for column in self.factors.T:
            part = column[rows] * values
            total += (np.bincount(owners, part, texts) ** 2 - np.bincount(owners, part**2, texts)) / 2
        return total


def _norms(owners: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """What values are divided by, so that long texts are not all pairs: the fourth root of their square."""
    return np.sqrt(np.sqrt(np.maximum(np.bincount(owners, values**2, texts), 1.0)))


def _summed(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; an empty group has the sum 0."""
    sums = np.zeros((len(sizes), rows.shape[1]), rows.dtype)
    held = np.flatnonzero(sizes)
    if len(held):
        sums[held] = np.add.reduceat(rows, np.concatenate(([0], np.cumsum(sizes[held])[:-1])))
    return sums


def _batches(examples: int, random: np.random.Generator) -> Iterator[np.ndarray]:
    """STEPS batches, in a new order whenever all examples have been seen."""
    queue = np.zeros(0, np.int64)
    for _ in range(STEPS):
        while len(queue) < min(BATCH, examples):
            queue = np.concatenate((queue, random.permutation(examples)))
        yield queue[:BATCH]
        queue = queue[BATCH:]


def train(owners: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray) -> Model:
    """Fit by AdaGrad on ``STEPS`` batches of examples; ``owners`` number the examples and ascend."""
    share = float(labels.mean()) if len(labels) else 0.5
    row_of = np.full(SLOTS, -1, np.int32)
    clipped = np.clip(share, 1e-6, 1 - 1e-6)
    bias = float(np.log(clipped / (1 - clipped)))
    if share in (0.0, 1.0) or not len(labels):
        return Model(bias, row_of, np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    kept = np.flatnonzero(np.bincount(slots, minlength=SLOTS) >= LEAST_HOLDERS)
    row_of[kept] = np.arange(len(kept), dtype=np.int32)
    rows = row_of[slots]
    owners, rows, values = owners[rows >= 0], rows[rows >= 0], values[rows >= 0]
    values = (values / _norms(owners, values, len(labels))[owners]).astype(np.float32)
    bounds = np.searchsorted(owners, np.arange(len(labels) + 1))
    # Toxic texts are few: without more weight their scores stay below one half.
    heft = np.where(labels > 0, (1 - share) / share, 1.0)
    random = np.random.default_rng(SEED)
    weights = np.zeros(len(kept), np.float32)
    factors = random.normal(0, 0.01, (len(kept), FACTORS)).astype(np.float32)
    seen_w, seen_v, seen_b = np.full_like(weights, 1e-2), np.full_like(factors, 1e-2), 1e-2
    for batch in _batches(len(labels), random):
        sizes = bounds[batch + 1] - bounds[batch]
        own = np.repeat(np.arange(len(batch)), sizes)
        first = np.repeat(bounds[batch] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        places = first + np.arange(len(own))
        row, x = rows[places], values[places]
        part = factors[row] * x[:, None]
        sums = _summed(part, sizes)
        squares = np.bincount(own, (part**2).sum(axis=1), len(batch))
        margin = bias + np.bincount(own, weights[row] * x, len(batch)) + ((sums**2).sum(axis=1) - squares) / 2
        miss = heft[batch] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]) / len(batch)
        push = miss[own] * x
        # The slope of the pairs of a term: its value times the sum of the other vectors.
        slope = push[:, None] * (sums[own] - part)
        turned = np.argsort(row, kind="stable")
        used, times = np.unique(row[turned], return_counts=True)
        step = _summed(push[turned, None], times)[:, 0] + DECAY * weights[used]
        seen_w[used] += step**2
        weights[used] -= RATE * step / np.sqrt(seen_w[used])
        step = _summed(slope[turned], times) + DECAY * factors[used]
        seen_v[used] += step**2
        factors[used] -= RATE * step / np.sqrt(seen_v[used])
        seen_b += miss.sum() ** 2
        bias -= RATE * miss.sum() / np.sqrt(seen_b)
    return Model(float(bias), row_of, weights.astype(np.float32), factors.astype(np.float32))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, label, slots and values of each labelled text."""
    for batch in batches:
        owners, slots, values = terms(batch.column(2).to_pylist())
        bounds = np.searchsorted(owners, np.arange(batch.num_rows + 1)).astype(np.int32)
        held = [
            pa.ListArray.from_arrays(bounds, pa.array(column, kind))
            for column, kind in ((slots.astype(np.int32), pa.int32()), (values, pa.float32()))
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *held], ["id", "label", "slots", "values"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the model of all examples of the task, which come in a fixed order."""
    labels, sizes, slots, values = [], [], [], []
    for batch in batches:
        labels.append(batch.column(1).to_numpy(zero_copy_only=False))
        sizes.append(np.diff(batch.column(2).offsets.to_numpy()))
        slots.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
        values.append(batch.column(3).flatten().to_numpy(zero_copy_only=False))
    if not labels:
        return
    owners = np.repeat(np.arange(sum(map(len, labels))), np.concatenate(sizes))
    model = train(owners, np.concatenate(slots), np.concatenate(values), np.concatenate(labels))
    slot = np.flatnonzero(model.row_of >= 0).astype(np.int32)
    columns = [
        pa.array([slot], pa.list_(pa.int32())),
        pa.array([model.weights], pa.list_(pa.float32())),
        pa.array([model.factors.ravel()], pa.list_(pa.float32())),
        pa.array([model.bias], pa.float64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["slot", "weight", "factors", "bias"])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model of ``label`` from labelled documents that are not held out, about ``max_rows`` of them."""
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label")).where(
        F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int(share * (1 << 32)))
    texts = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = dict(known.dtypes)["id"]
    toxic = (F.col("label") > 0).cast("double").alias("label")
    examples = stored(
        texts.join(F.broadcast(chosen), "id")
        .select("id", toxic, "text")
        .mapInArrow(_examples, f"id {kind}, label double, slots array<int>, values array<float>")
    )
    # Bounded by max_rows; in a fixed order, so that the model comes out the same each time.
    ordered = examples.repartition(1).sortWithinPartitions("id", "label", F.xxhash64("slots", "values"))
    found = ordered.mapInArrow(_fitted, MODEL).collect()
    if not found:
        return train(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    [row] = found
    row_of = np.full(SLOTS, -1, np.int32)
    row_of[np.array(row["slot"], np.int64)] = np.arange(len(row["slot"]), dtype=np.int32)
    factors = np.array(row["factors"], np.float32).reshape(-1, FACTORS)
    return Model(row["bias"], row_of, np.array(row["weight"], np.float32), factors)


def _scored(model: Broadcast):
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.value.score(texts.to_pylist()), pa.float64())

    return scored


def scored(documents: DataFrame, model: Model, text: str = "text", result: str = "score") -> DataFrame:
    """``documents`` with their toxicity, between 0 and 1."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    score = F.arrow_udf(_scored(sent), "double")
    return documents.withColumn(spare_name(documents, result), score(F.col(f"`{text}`").cast("binary")))
