"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item, or a whole shorter item. Of the six 5-word
grams of a window only the one with the least hash is kept as its fingerprint. The choice depends on
the window alone, so a document that holds the window has the same fingerprint: every shared span of
ten words is found. Fingerprints of documents are joined to those of the benchmark; the windows that
a hit lies in are then compared as a whole, and what matches is extended to the union of its words.

Scale. Documents are read once and never shuffled; they can be as many and as skewed as they like.
The benchmark is cut into segments that overlap by nine words, dealt into blocks of about
``BLOCK_WORDS`` words, and each block is broadcast, so what is broadcast has a fixed bound. A larger
benchmark has more blocks, which the same pass visits in turn.

Defined results: null, empty and symbol-only texts have no words and no hits; items without words
are never found; rows with equal item ids are one item; a null item id is the item "". Repeated
documents are judged alike. An empty benchmark hits nothing. Other columns pass through untouched;
beside one called like the result, the result has an underscore in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import NOT_ALPHANUMERIC, hashed_words, in_chunks, mix, spare_name, stored

# Words of a window, and of the grams whose least hash is its fingerprint.
WINDOW = 10
GRAM = 5
# Words of a benchmark segment and, on average, of a broadcast block.
SEGMENT = 4096
BLOCK_WORDS = 4_000_000

RESULT = (
    "struct<n_words: bigint, n_hit: bigint, items: array<string>, "
    "spans: array<struct<start: bigint, end: bigint>>>"
)
ARROW_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` consecutive words from every position on."""
    count = max(0, len(words) - width + 1)
    found = words[:count].copy()
    for shift in range(1, width):
        found *= _FACTOR
        found += words[shift : shift + count]
    return mix(found + np.uint64(width))


def fingerprints(words: np.ndarray) -> np.ndarray:
    """The least gram hash of every window of ``WINDOW`` words."""
    least = grams(words, GRAM)
    reached = 1
    grams_of_window = WINDOW - GRAM + 1
    while reached < grams_of_window:
        step = min(reached, grams_of_window - reached)
        least = np.minimum(least[: len(least) - step], least[step:])
        reached += step
    return least


class Among:
    """Membership in a set of hashes: a bitmap of low bits first, then a sorted array."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.unique(hashes)
        slots = 1 << max(16, int(16 * len(self.sorted)).bit_length())
        self.low = np.uint64(slots - 1)
        self.marked = np.zeros(slots, dtype=bool)
        self.marked[self.sorted & self.low] = True

    def positions(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of members, and the rank of each in the sorted set."""
        at = np.flatnonzero(self.marked[hashes & self.low])
        if not len(self.sorted):
            return at, at
        rank = np.searchsorted(self.sorted, hashes[at])
        rank = np.minimum(rank, len(self.sorted) - 1)
        same = self.sorted[rank] == hashes[at]
        return at[same], rank[same]


class Windows:
    """Windows of one length, and the items that each is in."""

    def __init__(self, length: int, hashes: list[np.ndarray], items: list[int]) -> None:
        self.length = length
        flat = np.concatenate(hashes)
        self.hashes = Among(flat)
        owner = np.repeat(np.array(items, np.int64), [len(h) for h in hashes])
        pairs = np.unique(np.stack([np.searchsorted(self.hashes.sorted, flat), owner]), axis=1)
        self.items = pairs[1]
        self.first = np.searchsorted(pairs[0], np.arange(len(self.hashes.sorted) + 1))

    def owners(self, ranks: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The items of the windows ``ranks``, each with the mark of its window."""
        counts = self.first[ranks + 1] - self.first[ranks]
        starts = np.repeat(self.first[ranks] - np.cumsum(counts) + counts, counts)
        return self.items[starts + np.arange(counts.sum())], np.repeat(marks, counts)


class Block:
    """A part of the benchmark, ready to be looked up."""

    def __init__(self, segments: list[tuple[str, np.ndarray]]) -> None:
        self.names = sorted({name for name, _ in segments})
        place = {name: i for i, name in enumerate(self.names)}
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for name, words in segments:
            by_length.setdefault(min(len(words), WINDOW), []).append((place[name], words))
        self.windows = [
            Windows(n, [grams(words, n) for _, words in found], [i for i, _ in found])
            for n, found in sorted(by_length.items())
        ]
        long = [fingerprints(words) for _, words in by_length.get(WINDOW, [])]
        self.marks = Among(np.concatenate([*long, np.empty(0, np.uint64)]))

    def _candidates(self, words: np.ndarray) -> np.ndarray:
        """Starts of the windows whose fingerprint the benchmark has."""
        prints = fingerprints(words)
        if not len(prints):
            return np.empty(0, np.int64)
        # Neighbouring windows mostly share a fingerprint; it is looked up once.
        new = np.concatenate(([0], np.flatnonzero(prints[1:] != prints[:-1]) + 1))
        hit, _ = self.marks.positions(prints[new])
        ends = np.append(new, len(prints))
        counts = ends[hit + 1] - ends[hit]
        return np.repeat(ends[hit] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())

    def search(
        self, words: np.ndarray, bounds: np.ndarray, covered: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Mark the words hit in ``covered``; (document, item) of all hits, without repeats."""
        found = [np.empty((2, 0), np.int64)]
        for windows in self.windows:
            n = windows.length
            if n == WINDOW:
                start = self._candidates(words)
                hashes = grams(words, n)[start]
            else:
                hashes = grams(words, n)
                start = np.arange(len(hashes))
            at, rank = windows.hashes.positions(hashes)
            start = start[at]
            document = np.searchsorted(bounds, start, side="right") - 1
            inside = start + n <= bounds[document + 1]
            start, rank, document = start[inside], rank[inside], document[inside]
            covered[(start[:, None] + np.arange(n)).ravel()] = True
            pairs = np.unique(np.stack([document, rank]), axis=1)
            item, document = windows.owners(pairs[1], pairs[0])
            found.append(np.stack([document, item]))
        return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def _runs(covered: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of each run of covered words; a run ends with its document."""
    before = np.concatenate(([False], covered[:-1]))
    after = np.concatenate((covered[1:], [False]))
    first, last = np.zeros(len(covered) + 1, bool), np.zeros(len(covered) + 1, bool)
    first[bounds] = last[bounds - 1] = True
    start = np.flatnonzero(covered & (~before | first[:-1]))
    end = np.flatnonzero(covered & (~after | last[:-1])) + 1
    return np.searchsorted(bounds, start, side="right") - 1, start, end


def _judge(block: Block, texts: list[bytes | None], earlier: list[dict | None]) -> list[dict]:
    """Results for some texts, on top of those of the blocks before."""
    bounds, words, _, _ = hashed_words(texts, NOT_ALPHANUMERIC)
    covered = np.zeros(len(words), dtype=bool)
    results = [
        {"n_words": int(bounds[i + 1] - bounds[i]), "n_hit": 0, "items": [], "spans": []}
        for i in range(len(texts))
    ]
    for i, known in enumerate(earlier):
        if known is not None:
            results[i]["items"] = list(known["items"])
            for span in known["spans"]:
                covered[bounds[i] + span["start"] : bounds[i] + span["end"]] = True
    if len(words):
        for document, item in zip(*(x.tolist() for x in block.search(words, bounds, covered))):
            results[document]["items"].append(block.names[item])
        for document, start, end in zip(*(x.tolist() for x in _runs(covered, bounds))):
            result, shift = results[document], int(bounds[document])
            result["spans"].append({"start": start - shift, "end": end - shift})
            result["n_hit"] += end - start
    for result in results:
        result["items"] = sorted(set(result["items"]))
    return results


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column(0).to_pylist()
        bounds, words, _, _ = hashed_words(batch.column(1).to_pylist(), NOT_ALPHANUMERIC)
        found = [
            (name, words[at : min(at + SEGMENT, bounds[i + 1])].view(np.int64).tolist())
            for i, name in enumerate(names)
            for at in range(bounds[i], max(bounds[i] + 1, bounds[i + 1] - WINDOW + 1), SEGMENT - WINDOW + 1)
            if bounds[i] < bounds[i + 1]
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name for name, _ in found], pa.string()),
                pa.array([segment for _, segment in found], pa.list_(pa.int64())),
            ],
            ["item", "words"],
        )


def blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words; an empty one is one block."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")), F.col(f"`{text}`").cast("binary")
    )
    segments = stored(items.mapInArrow(_segments, "item string, words array<bigint>"))
    words = segments.agg(F.sum(F.size("words"))).first()[0] or 0
    count = max(1, -(-words // block_words))
    for number in range(count):
        # As many rows as a block has segments: bounded by block_words.
        rows = segments.where(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == number).collect()
        yield Block([(row["item"], np.array(row["words"], np.int64).view(np.uint64)) for row in rows])


def _judged(block: Broadcast):
    def judged(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        results, known, at = [], earlier.to_pylist(), 0
        for chunk in in_chunks(texts.to_pylist()):
            results += _judge(block.value, chunk, known[at : at + len(chunk)])
            at += len(chunk)
        return pa.array(results, ARROW_RESULT)

    return judged


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
    result: str = "hits",
) -> DataFrame:
    """``documents`` with one more column, ``result``: words, words hit, items hit, and spans of words."""
    context = documents.sparkSession.sparkContext
    found: Column = F.lit(None).cast(RESULT)
    for block in blocks(benchmark, item, item_text, block_words):
        judged = F.arrow_udf(_judged(context.broadcast(block)), RESULT)
        found = judged(F.col(f"`{text}`").cast("binary"), found)
    return documents.withColumn(spare_name(documents, result), found)


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents that share no window with the benchmark; columns as before."""
    hits = spare_name(documents, "hits")
    judged = contamination(documents, benchmark, text, item, item_text, result=hits)
    return judged.where(F.col(hits)["n_hit"] == 0).drop(hits)
