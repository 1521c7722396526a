"""Substring deduplication by sliding spans of sentences.

A sentence ends with an end mark, with a line, and, so that no sentence is long, after the word with
the least hash of every ``WINDOW`` words in a row, where words that end a sentence anyway are the
least. From each sentence on, the shortest run of at least ``MIN_SENTENCES`` sentences and
``MIN_WORDS`` words is hashed. Two texts that share N words in a row, white space included, share a
run for every N >= 3 WINDOW + MIN_WORDS - 1, that is 49: windows inside the passage choose equally in
both texts, one of the first WINDOW words ends a sentence, a run from there ends within MIN_WORDS +
WINDOW - 1 words, and that is WINDOW words before the passage ends. Where scripts are written without
blanks (Chinese, Japanese, Thai, Lao, Burmese, Khmer) every character is a word. Equal runs are
joined over all
documents; every occurrence but the first (smallest id, then earliest place) is a repeat, and the
sentences that repeats cover are removed.

Scale. Each task first keeps one occurrence per run of its batch, so a passage that a third of all
documents share is a row per batch, not per document, when runs are shuffled. The runs of a document
are joined back only where they repeat. Texts move only if the table of repeats is too large to
broadcast.

Defined results: null, empty and short texts have no runs and stay; a document without an id comes
after all others, and such documents do not take text from each other; rows equal in id and text are
one document and change alike; an empty table gives no rows. Other columns pass through untouched;
beside one called like the result, the result has an underscore in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.llm.common import SPACES, Words, in_chunks, runs_hashed, separators, spare_name, stored, words_in
from aerolag.operators.joins import lookup_join

WINDOW = 10
MIN_SENTENCES = 2
MIN_WORDS = 20

_END_MARKS = separators(b".!?")


# Full stop, exclamation and question mark of Chinese and Japanese.
_WIDE_MARKS = [tuple(mark.encode()) for mark in "\u3002\uff01\uff1f"]


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of scripts without blanks begin and end."""
    at = np.flatnonzero(data >= 0xE0)
    lead, second = data[at], data[np.minimum(at + 1, len(data) - 1)]
    found = (lead >= 0xE3) & (lead <= 0xE9)
    found |= (lead == 0xEF) & ((second >= 0xBC) & (second <= 0xBE) | (second >= 0xA4) & (second <= 0xAB))
    found |= (lead == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    found |= (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    found |= (lead == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))
    at = at[found]
    return at, np.minimum(at + np.where(data[at] == 0xF0, 4, 3), len(data) - 1)


def said(texts: list[bytes | None]) -> Words:
    """Words of the texts; a character of a script without blanks is a word."""
    words = words_in(texts, SPACES)
    begin, end = _unspaced(words.data)
    if not len(begin):
        return words
    # A character may begin a word, and what follows it may; a blank may not.
    starts = np.union1d(words.starts, np.concatenate((begin, end[~SPACES[words.data[end]]])))
    word = np.searchsorted(words.starts, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(words.data)), words.ends[word])
    hashes = runs_hashed(words.data.astype(np.uint64) + np.uint64(1), starts, ends)
    return Words(np.searchsorted(starts, words.offsets), hashes, starts, ends, words.offsets, words.data)


def _marked(words: Words) -> np.ndarray:
    """Words that end with an end mark, a line or their text."""
    last = words.ends - 1
    ends = _END_MARKS[words.data[last]]
    third = np.maximum(last - 2, 0)
    for a, b, c in _WIDE_MARKS:
        ends |= (words.data[last] == c) & (words.data[last - 1] == b) & (words.data[third] == a)
    lines = np.cumsum(words.data == 10)
    ends[:-1] |= lines[words.starts[1:]] > lines[words.ends[:-1] - 1]
    filled = words.bounds[1:] > words.bounds[:-1]
    ends[words.bounds[1:][filled] - 1] = True
    return ends


def _least(words: Words, marked: np.ndarray) -> np.ndarray:
    """The last of the least words of every window within a text; marked words are the least."""
    count = len(words.hashes) - WINDOW + 1
    if count < 1:
        return np.zeros(0, np.int64)
    keys = (words.hashes >> np.uint64(1)) | (~marked).astype(np.uint64) << np.uint64(63)
    least, place = keys[:count].copy(), np.zeros(count, np.int64)
    for k in range(1, WINDOW):
        lower = keys[k : k + count] <= least
        np.copyto(least, keys[k : k + count], where=lower)
        place[lower] = k
    text = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    whole = np.flatnonzero(text[:count] == text[WINDOW - 1 :])
    return whole + place[whole]


def sentences(words: Words) -> np.ndarray:
    """First word of every sentence, and the number of words at the end."""
    count = len(words.hashes)
    if not count:
        return np.zeros(1, np.int64)
    ends = _marked(words)
    ends[_least(words, ends)] = True
    starts = np.zeros(count + 1, bool)
    starts[1:] = ends
    starts[words.bounds] = True
    return np.flatnonzero(starts)


def runs(words: Words, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, first sentence, end sentence and hash of every run; sentences are counted in the text."""
    first = np.arange(len(starts) - 1)
    end = np.searchsorted(starts, starts[first] + MIN_WORDS)
    end = np.maximum(end, first + MIN_SENTENCES)
    inside = end < len(starts)
    first, end = first[inside], end[inside]
    text = np.searchsorted(words.bounds, starts[first], side="right") - 1
    own = starts[end] <= words.bounds[text + 1]
    text, first, end = text[own], first[own], end[own]
    hashes = runs_hashed(words.hashes, starts[first], starts[end])
    base = np.searchsorted(starts, words.bounds)[text]
    return text, first - base, end - base, hashes


_MADE = {"run": pa.int64(), "first": pa.int32(), "end": pa.int32(), "repeat": pa.bool_()}


def _all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, same, text) to runs; ``repeat`` where the batch itself has an earlier occurrence."""
    for batch in batches:
        ids, same = batch.column(0), np.array(batch.column(1))
        texts, found, at = batch.column(2).to_pylist(), [], 0
        for chunk in in_chunks(texts):
            words = said(chunk)
            text, first, end, hashes = runs(words, sentences(words))
            found.append((text + at, first, end, hashes.view(np.int64)))
            at += len(chunk)
        text, first, end, run = (np.concatenate(column) for column in zip(*found))
        # By id, nulls last; rows of one document stand together.
        order = np.lexsort((same, np.array(pc.rank(ids, tiebreaker="dense")).astype(np.int64)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sorted_ = np.lexsort((first, place[text], run))
        again = np.zeros(len(run), bool)
        again[sorted_[1:]] = run[sorted_[1:]] == run[sorted_[:-1]]
        # The first document's own rows may come twice; those are one occurrence.
        group = np.maximum.accumulate(np.where(again[sorted_], 0, np.arange(len(run))))
        leader = np.empty(len(run), np.int64)
        leader[sorted_] = sorted_[group]
        id_list = ids.to_pylist()
        twins = (same[text] == same[text[leader]]) & (first == first[leader])
        twins &= np.fromiter((id_list[a] == id_list[b] for a, b in zip(text, text[leader])), bool, len(text))
        without_id = np.array(ids.is_null())
        repeat = again & ~twins & ~without_id[text[leader]]
        chosen = np.flatnonzero(repeat | ~again | without_id[text])
        made = [run[chosen], first[chosen], end[chosen], repeat[chosen]]
        arrays = [pa.array(x, kind) for x, kind in zip(made, _MADE.values())]
        taken = pa.array(text[chosen])
        yield pa.RecordBatch.from_arrays(
            [ids.take(taken), batch.column(1).take(taken), *arrays], ["id", "same", *_MADE]
        )


def repeats(texts: DataFrame) -> DataFrame:
    """(id, same, spans) of the documents with repeats; ``texts`` has the columns id, same and text."""
    schema = T.StructType(
        [
            texts.schema["id"],
            T.StructField("same", T.LongType()),
            T.StructField("run", T.LongType()),
            T.StructField("first", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("repeat", T.BooleanType()),
        ]
    )
    chosen = texts.select("id", "same", F.col("text").cast("binary"))
    found = stored(chosen.mapInArrow(_all_runs, schema))
    open_ = found.where(~F.col("repeat"))
    # Within one document the batch has settled it; between documents the smallest id is first.
    first = (
        open_.groupBy("run")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"), F.count("id").alias("ids"))
        .where((F.col("low") != F.col("high")) | ((F.col("ids") > 0) & (F.col("ids") < F.col("n"))))
        .select("run", "low")
    )
    later = F.coalesce(F.col("id") != F.col("low"), F.lit(True))
    columns = ["id", "same", "first", "end"]
    everywhere = open_.join(first, "run").where(later).select(*columns)
    spans = everywhere.union(found.where("repeat").select(*columns))
    gathered = spans.groupBy("id", "same").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    merged = F.arrow_udf(_merged, SPANS)("spans")
    return stored(gathered.select("id", "same", merged.alias("spans")))


SPANS = "array<struct<first: int, end: int>>"


def _merged(spans: pa.Array) -> pa.Array:
    """The union of each list of runs as few runs: a copied text is one, not one per sentence."""
    results = []
    for found in spans.to_pylist():
        runs_: list[dict] = []
        for run in sorted(found, key=lambda run: run["first"]):
            if runs_ and run["first"] <= runs_[-1]["end"]:
                runs_[-1]["end"] = max(runs_[-1]["end"], run["end"])
            else:
                runs_.append(dict(run))
        results.append(runs_)
    return pa.array(results, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))


RESULT = "struct<n_sentences: bigint, n_removed: bigint, n_words_removed: bigint, text: string>"
_ARROW = pa.struct(
    [("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_words_removed", pa.int64()), ("text", pa.string())]
)


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The texts without the sentences that spans cover; a text without spans stays as it is."""
    results = []
    for text, covered in zip(texts.to_pylist(), spans.to_pylist()):
        words = said([text])
        starts = sentences(words)
        gone = np.zeros(len(starts) - 1, bool)
        for span in covered or []:
            gone[span["first"] : span["end"]] = True
        lengths = np.diff(starts)
        left = text
        if gone.any():
            # A sentence reaches to the next one; what stands before the first belongs to it.
            edges = np.append(words.starts[starts[:-1]], len(text))
            edges[0] = 0
            left = b"".join(text[edges[i] : edges[i + 1]] for i in np.flatnonzero(~gone))
        results.append(
            {
                "n_sentences": len(gone),
                "n_removed": int(gone.sum()),
                "n_words_removed": int(lengths[gone].sum()),
                "text": None if left is None else left.decode("utf-8"),
            }
        )
    return pa.array(results, _ARROW)


def deduplicated(
    documents: DataFrame, id: str = "doc_id", text: str = "text", result: str = "dedup"
) -> DataFrame:
    """``documents`` with one more column, ``result``: sentences, those removed, and the text left."""
    packed = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row"),
        F.col(f"`{id}`").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("same"),
        F.col(f"`{text}`").alias("text"),
    )
    found = repeats(packed.select("id", "same", "text"))
    # A null id is spelled out, so that it joins.
    key = F.xxhash64(F.col("id").isNull(), "id", "same")
    joined = lookup_join(
        packed.withColumn("key", key), found.select(key.alias("key"), "spans"), ["key"], "left"
    )
    made = F.arrow_udf(_without, RESULT)(F.col("text").cast("binary"), F.col("spans"))
    return joined.select("row", made.alias("made")).select("row.*", F.col("made").alias(spare_name(documents, result)))
