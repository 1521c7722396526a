"""Mixture-controlled packing by deficit round robin over source queues.

Every source is a queue of tokens. In each round a queue earns credit in proportion to its target
share and sends one token when its credit has reached a half, paying one; what it is owed or owes,
its deficit, carries over to the next round, the next window and the next partition. Windows of
``WINDOW_SEQUENCES`` sequences are filled in that order, so every window holds the target
proportions to within a token or so per queue; within a window the queues follow each other, so that
documents are cut at sequence ends and seldom elsewhere. All sequences but the last are full.

Sources with a target have queues of their own, and so have all that are due at least ``MIN_DUE``
tokens of every window, of which a window has no more than so many. To hold the share of a smaller
source to a token, each of its documents would be cut into single tokens. Such sources therefore
carry their deficit until it pays for a whole document: a second round robin, with documents for
tokens, orders them within one queue, which holds their common share of every window. A source's
document goes when the source is owed a fixed part of it, a part that a hash of its name chooses, so
that sources of one document each are spread over the whole queue.

Scale. The state of all queues after any round has a closed form, so no task waits for another: the
only totals needed are tokens per source and, for the order within a queue, tokens per task and
source. One pass tokenises and stores ids; a second reads them and cuts each document where the
windows and sequences begin. No text is shuffled, and ids only if the places of small sources, or of
sources by task, are too many to broadcast. The order of small sources' documents has a closed form
too, their place between the first and the last token of the source; sums run over ranges of it.

Defined results: a null or empty text is its end id alone; a null source is the source ""; equal
rows are packed as often as they occur; an empty table gives no pieces. Only id, text and source
columns are read.
"""

from __future__ import annotations

import base64
import functools
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.llm.common import stored
from aerolag.operators.joins import lookup_join

SEQUENCE = 1024
# Sequences that together hold the target proportions: about what one training step sees.
WINDOW_SEQUENCES = 64
END_ID = 0
# A source due fewer tokens of a window sends whole documents in turn with others like it.
MIN_DUE = 64
# Tokens in a range of such documents that one task sums, until there are RANGES of them.
RANGE_TOKENS = 1 << 22
RANGES = 1 << 16
# Texts with a longer run without white space go to the tokenizer whose cost is not quadratic in it.
LONG_RUN = 1 << 14


class Encoder:
    """Ids of the tokenizer in the JSON file ``path``.

    ``ranks`` may name a file with the same vocabulary as ranks and its ``pattern``; it is then used
    for the texts that hold no special token, which it encodes equally and several times faster.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = list(self.slow.get_added_tokens_decoder().values())
        self.special = [token.content for token in self.special]
        self.dtype = np.uint16 if self.slow.get_vocab_size() <= 1 << 16 else np.uint32
        self.fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as file:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
            )

    def ids(self, text: str) -> bytes:
        """Ids of the text and the end id."""
        ordinary = self.fast is not None and not any(s in text for s in self.special)
        if ordinary and len(text) > LONG_RUN:
            ordinary = max(map(len, text.split())) <= LONG_RUN if text.strip() else False
        if ordinary:
            found = self.fast.encode_ordinary(text)
        else:
            found = self.slow.encode(text, add_special_tokens=False).ids
        found.append(END_ID)
        return np.array(found, self.dtype).tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(path, ranks, pattern)


def _tokenised(path: str, ranks: str | None, pattern: str | None):
    """Rows (id, source, text) to (id, source, part, before, length, ids); ``before`` counts the
    tokens of the same source that this task has seen earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path, ranks, pattern), TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for batch in batches:
            sources = batch.column(1).to_pylist()
            ids = [encoder.ids(text or "") for text in batch.column(2).to_pylist()]
            lengths = [len(x) // encoder.dtype().itemsize for x in ids]
            before = []
            for source, length in zip(sources, lengths):
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + length
            made = {
                "part": pa.array([part] * len(ids), pa.int64()),
                "before": pa.array(before, pa.int64()),
                "length": pa.array(lengths, pa.int64()),
                "ids": pa.array(ids, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made.values()], ["id", "source", *made]
            )

    return run


class Schedule:
    """Which tokens of which queue are in which window."""

    def __init__(self, totals: list[int], weights: list[int], window: int) -> None:
        self.totals, self.weights, self.window = totals, weights, window
        self.all, self.weight = sum(totals), sum(weights)
        self.windows = -(-self.all // window)
        # Rounds after which every queue is empty.
        self.rounds = max((-(-t * self.weight // w) + 1 for t, w in zip(totals, weights)), default=0)
        # About a million numbers are kept, however many queues there are.
        self.sent = functools.lru_cache(maxsize=16 + (1 << 20) // max(1, len(totals)))(self._sent)

    def __reduce__(self):
        return Schedule, (self.totals, self.weights, self.window)

    def _after(self, rounds: int) -> list[int]:
        """Tokens each queue has sent after so many rounds: credit earned, rounded at a half."""
        double = 2 * self.weight
        return [
            min(total, (2 * rounds * weight + self.weight) // double)
            for total, weight in zip(self.totals, self.weights)
        ]

    def _sent(self, windows: int) -> tuple[int, ...]:
        """Tokens each queue has sent when so many windows are full."""
        target = min(windows * self.window, self.all)
        # While no queue is empty, so many rounds have sent so many tokens but for one a queue.
        low, high = max(0, target - len(self.totals)), min(self.rounds, target + len(self.totals))
        if sum(self._after(low)) > target:
            low = 0
        if sum(self._after(high)) <= target:
            high = self.rounds
        while low < high:
            middle = (low + high + 1) // 2
            if sum(self._after(middle)) <= target:
                low = middle
            else:
                high = middle - 1
        sent, more = self._after(low), self._after(low + 1)
        # Queues that send in the round during which the window fills do so in order.
        left = target - sum(sent)
        for queue, (now, then) in enumerate(zip(sent, more)):
            if left and then > now:
                sent[queue] += 1
                left -= 1
        return tuple(sent)

    def window_of(self, queue: int, token: int, guess: int) -> int:
        """The window that holds a token of a queue; ``guess`` is where to look first."""
        if self.sent(guess)[queue] <= token < self.sent(guess + 1)[queue]:
            return guess
        return bisect_right(range(self.windows), token, key=lambda w: self.sent(w + 1)[queue])

    def pieces(self, queue: int, start: int, length: int, guess: int) -> Iterator[tuple]:
        """(window, sequence, offset, first token in the document, tokens) of a document's pieces."""
        done, w = 0, self.window_of(queue, start, guess)
        while done < length:
            begin, end = self.sent(w), self.sent(w + 1)
            at = sum(end[:queue]) - sum(begin[:queue]) + start + done - begin[queue]
            stop = min(length, end[queue] - start)
            while done < stop:
                offset = at % SEQUENCE
                size = min(stop - done, SEQUENCE - offset)
                yield w, (w * self.window + at) // SEQUENCE, offset, done, size
                done, at = done + size, at + size
            w += 1


def _cut(schedule: Schedule, dtype: type, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[int, int] = {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 5)]
            rows: list[tuple] = []
            row_of, ids = [], []
            for row, (queue, start, length, held) in enumerate(zip(*columns)):
                wide = np.frombuffer(held, dtype).astype("<u4")
                view = memoryview(wide).cast("B")
                for w, sequence, offset, first, size in schedule.pieces(
                    queue, start, length, near.get(queue, 0)
                ):
                    near[queue] = w
                    crc = zlib.crc32(view[4 * first : 4 * (first + size)])
                    rows.append((first, size, crc, length, sequence, offset))
                    row_of.append(row)
                    if with_ids:
                        ids.append(wide[first : first + size].view(np.int32))
            names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            table = np.array(rows, np.int64).reshape(-1, len(names))
            made = {name: pa.array(table[:, i]) for i, name in enumerate(names)}
            if with_ids:
                made["ids"] = pa.array(ids, pa.list_(pa.int32()))
            taken = batch.column(0).take(pa.array(row_of, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken, *made.values()], ["id", *made])

    return run


def _queues(tokens: DataFrame, targets: dict[str, int], window: int) -> tuple[DataFrame, int]:
    """(source, part, queue, offset, length, size): where a task's tokens of a source begin among all
    ``size`` tokens of it; and the number of the queue that small sources share."""
    parts = stored(tokens.groupBy("source", "part").agg(F.sum("length").alias("length")))
    sizes = stored(parts.groupBy("source").agg(F.sum("length").alias("size")))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Bounded: no more than window / MIN_DUE sources can be due that much of a window.
    largest = (
        sizes.where(~F.col("source").isin(list(targets)))
        .where(F.col("size") * window >= MIN_DUE * total)
        .orderBy(F.desc("size"), "source")
        .collect()
    )
    own = [*sorted(targets), *(row["source"] for row in largest)]
    names = F.array(*map(F.lit, own)).cast("array<string>")
    place = F.array_position(names, F.col("source")).cast("int") - 1
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = lookup_join(parts, sizes, ["source"], "inner").select(
        "source",
        "part",
        F.when(place < 0, len(own)).otherwise(place).alias("queue"),
        F.coalesce(F.sum("length").over(running), F.lit(0)).alias("offset"),
        "length",
        "size",
    )
    return stored(placed), len(own)


def _in_turn(documents: DataFrame, total: int) -> DataFrame:
    """(source, part, before, start): where each document of the small sources begins in their queue.

    ``documents`` has the start of each among the ``size`` tokens of its source, and its length.
    """
    ranges = min(RANGES, 1 + total // RANGE_TOKENS)
    owed = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / F.lit(1 << 20)
    turn = (F.col("start") + owed * F.col("length")) / F.col("size")
    dealt = stored(
        documents.withColumn("turn", turn).withColumn("range", F.floor(F.col("turn") * ranges))
    )
    until = (Window.unboundedPreceding, -1)
    begins = dealt.groupBy("range").agg(F.sum("length").alias("held")).select(
        "range", F.coalesce(F.sum("held").over(Window.orderBy("range").rowsBetween(*until)), F.lit(0)).alias("begin")
    )
    within = Window.partitionBy("range").orderBy("turn", "source", "start").rowsBetween(*until)
    at = F.coalesce(F.sum("length").over(within), F.lit(0))
    summed = dealt.select("source", "part", "before", "range", at.alias("at"))
    # At most RANGES rows.
    return stored(
        summed.join(F.broadcast(begins), "range").select(
            "source", "part", "before", (F.col("begin") + F.col("at")).alias("start")
        )
    )


def weights_of(sizes: list[int], aimed: list[int | None]) -> list[int]:
    """Whole-number weights of queues in one unit, from their tokens and the targets that some have.

    Queues without a target keep their share of all tokens; what is left is split by the targets.
    """
    given = sum(weight for weight in aimed if weight is not None)
    tokens = sum(size for size, weight in zip(sizes, aimed) if weight is not None)
    if not given:
        return sizes
    return [size * given if weight is None else weight * tokens for size, weight in zip(sizes, aimed)]


def pack(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    targets: dict[str, int] | None = None,
    window_sequences: int = WINDOW_SEQUENCES,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents and their places in sequences of ``SEQUENCE`` tokens.

    ``targets`` gives sources whole-number weights above zero: sources it leaves out keep their share
    of all tokens, and the others split the rest by weight. Without it all queues end together. A
    queue that is empty leaves its share to the others. ``with_ids`` adds the ids of each piece.
    """
    targets = targets or {}
    if any(weight <= 0 for weight in targets.values()):
        raise ValueError("targets are whole numbers above zero")
    chosen = documents.select(
        F.col(f"`{id}`").alias("id"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.col(f"`{text}`").alias("text"),
    )
    kind = chosen.schema["id"]
    fields = [kind, T.StructField("source", T.StringType())]
    fields += [T.StructField(n, T.LongType()) for n in ("part", "before", "length")]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType())])
    tokens = stored(chosen.mapInArrow(_tokenised(tokenizer, ranks, pattern), schema))
    window = SEQUENCE * window_sequences
    places, shared = _queues(tokens, targets, window)
    queues = places.groupBy("queue").agg(F.sum("length").alias("size"), F.min("source").alias("name"))
    found = sorted(queues.collect())
    number = {row["queue"]: i for i, row in enumerate(found)}
    totals = [row["size"] for row in found]
    # The shared queue is named after a source without a target.
    weights = weights_of(totals, [targets.get(row["name"]) for row in found])
    schedule = Schedule(totals, weights, window)
    numbers = F.create_map(*[F.lit(x) for pair in number.items() for x in pair]) if number else None
    queue = numbers[F.col("queue")] if number else F.col("queue")
    placed = lookup_join(
        tokens, places.drop("length").withColumn("queue", queue), ["source", "part"], "inner"
    ).withColumn("start", F.col("offset") + F.col("before"))
    columns = ["id", "queue", "start", "length", "ids"]
    if shared in number:
        small = F.col("queue") == number[shared]
        rest = placed.where(small)
        turns = _in_turn(
            rest.select("source", "part", "before", "start", "size", "length"), totals[number[shared]]
        )
        moved = lookup_join(rest.drop("start"), turns, ["source", "part", "before"], "inner")
        placed = placed.where(~small).select(columns).unionByName(moved.select(columns))
    else:
        placed = placed.select(columns)
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    result = T.StructType(
        [kind]
        + [T.StructField(name, T.LongType()) for name in longs]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )
    dtype = Encoder(tokenizer).dtype
    return placed.mapInArrow(_cut(schedule, dtype, with_ids), result).withColumnRenamed("id", id)
