"""Near-duplicate documents by banded MinHash and odd sketches.

Each document is a set of word shingles. MinHash samples of the set are folded twice: into band
hashes that propose candidates, and into an odd sketch, a bitmap whose bits hold the parity of the
samples falling on them. The XOR of two sketches is the sketch of the samples in which they differ,
so its population count tells how similar two sets are, most precisely where they are similar.
Candidates that pass it are confirmed on the full sets.

Scale. Documents with equal sets form a class, and only classes are compared; copies cost a row.
A bucket of a band never becomes all its pairs. Each class of a bucket is compared with one leader;
pairs near by their sketches make families. Only where classes of one bucket are in *different*
families is the bucket joined with itself, by a condition that counts bits, so that only pairs
passing the sketch leave the join. Then every pair that shares a bucket and passes the sketch is
within a family. Most families are one component by their confirmed links to leaders; where one
falls into parts, what is outside its largest part is compared with all of it, in blocks.

Chances: a pair at exactly the threshold of 0.8 shares no band with probability
(1 - 0.8 ** ROWS) ** BANDS = 3e-6, and its sketch is refused beyond five standard deviations. Sets
are sets of 64-bit hashes.

Defined results: a null or empty text, or one of white space, is linked with nothing; equal rows
share a component; a null id is larger than all others and the id of a component only if it holds
no other; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.llm.common import SPACES, hashed_words, in_chunks, mix, stored
from aerolag.llm.components import Parts, components
from aerolag.operators.joins import fits_broadcast

BANDS = 24
ROWS = 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 256
# Differing bits beyond which a pair is refused: 33 expected at 0.8, and five deviations of 7.7.
MAX_BITS = 72
# Shingles handled in one step; shingles and sets of a block that is compared with another block.
BLOCK = 8192
BLOCK_SHINGLES = 250_000
BLOCK_SETS = 2048
# Shingles counted in one matrix product, a column each.
COLUMNS = 2048
# Classes of a bucket in one block, where what is outside its largest family is compared with it.
BLOCK_ROWS = 4096

_RANDOM = np.random.default_rng(20240901)
_FACTORS = _RANDOM.integers(0, 1 << 32, (SAMPLES, 1), dtype=np.uint32) | np.uint32(1)
_TERMS = _RANDOM.integers(0, 1 << 32, (SAMPLES, 1), dtype=np.uint32)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted set of hashed shingles; fewer words than ``width`` are one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    grams = words[:count].copy()
    for shift in range(1, width):
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams += words[shift : shift + count]
    return np.unique(mix(grams + np.uint64(width)))


def minima(found: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    return np.min(
        [
            (short[at : at + BLOCK] * _FACTORS + _TERMS).min(axis=1)
            for at in range(0, len(short), BLOCK)
        ],
        axis=0,
    )


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """One hash per band, different for different bands; ``samples`` has a row per set."""
    rows = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    found = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for position in range(ROWS):
        found = mix(found * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, position])
    return found.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Bitmaps as 64-bit numbers: a bit is set if an odd number of samples fell on it."""
    numbered = samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))
    bit = (mix(numbered) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bit += np.arange(len(samples))[:, None] * SKETCH_BITS
    counts = np.bincount(bit.ravel(), minlength=len(samples) * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _list_array(lengths: list[int], values: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    bounds, words, _, _ = hashed_words(texts, SPACES)
    return [shingles(words[bounds[i] : bounds[i + 1]], width) for i in range(len(texts))]


def _key(found: np.ndarray) -> bytes | None:
    """Documents with equal sets have equal keys; an empty set has none."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _over_texts(compute: Callable, width: int):
    """``compute`` over the last column of each batch, in chunks; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in in_chunks(batch.column(batch.num_columns - 1).to_pylist()):
                passed = batch.slice(at, len(texts)).columns[:-1]
                at += len(texts)
                names = batch.schema.names[:-1]
                made = compute(_sets(texts, width))
                yield pa.RecordBatch.from_arrays([*passed, *made.values()], [*names, *made])

    return run


def _sketched(sets: list[np.ndarray]) -> dict[str, pa.Array]:
    full = [found for found in sets if len(found)]
    samples = np.array([minima(found) for found in full], np.uint32).reshape(-1, SAMPLES)
    held = [int(len(found) > 0) for found in sets]
    return {
        "key": pa.array([_key(found) for found in sets], pa.binary()),
        "n": pa.array([len(found) for found in sets], pa.int64()),
        "bands": _list_array([h * BANDS for h in held], band_hashes(samples).ravel()),
        "odd": _list_array([h * SKETCH_BITS // 64 for h in held], odd_sketches(samples).ravel()),
    }


def _spelled_out(sets: list[np.ndarray]) -> dict[str, pa.Array]:
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    return {
        "key": pa.array([_key(found) for found in sets], pa.binary()),
        "held": _list_array([len(found) for found in sets], flat.view(np.int64)),
    }


def _differing(x: Column, y: Column) -> Column:
    """Bits in which two sketches differ."""
    words = [F.bit_count(F.get(x, i).bitwiseXOR(F.get(y, i))) for i in range(SKETCH_BITS // 64)]
    return sum(words[1:], words[0])


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``."""
    counts = np.zeros((len(x), len(y)), np.float32)
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    if not len(both):
        return counts

    def places(sets: list[np.ndarray]) -> list[np.ndarray]:
        found = [np.searchsorted(both, held) for held in sets]
        return [at[both[np.minimum(at, len(both) - 1)] == held] for at, held in zip(found, sets)]

    x_at, y_at = places(x), places(y)
    for low in range(0, len(both), COLUMNS):
        high = min(low + COLUMNS, len(both))
        matrices = []
        for sets in (x_at, y_at):
            matrix = np.zeros((len(sets), high - low), np.float32)
            for row, at in zip(matrix, sets):
                begin, end = np.searchsorted(at, (low, high))
                row[at[begin:end] - low] = 1
            matrices.append(matrix)
        counts += matrices[0] @ matrices[1].T
    return counts


def _linked(percent: int):
    """Links of a block: no more than are needed to join the parts that it shows to be linked."""

    def linked(block: pa.Table) -> pa.Table:
        keys, parts = block["key"].to_pylist(), block["part"].to_pylist()
        column = block["held"].combine_chunks()
        offsets, flat = np.array(column.offsets), np.array(column.values)
        held = [np.sort(flat[offsets[i] : offsets[i + 1]]) for i in range(len(keys))]
        outside = np.array(block["outside"])
        x, y = np.flatnonzero(outside), np.flatnonzero(~outside)
        links: list[tuple[bytes, bytes]] = []
        if len(x) and len(y):
            shared = _common([held[i] for i in x], [held[i] for i in y])
            sizes = np.array([len(h) for h in held], np.float32)
            union = sizes[x][:, None] + sizes[y][None, :] - shared
            part = np.unique(np.array([p.hex() for p in parts]), return_inverse=True)[1].tolist()
            by_part = np.array(part)
            differ = by_part[x][:, None] != by_part[y][None, :]
            # Kruskal's rule: a link counts if it joins what is still apart.
            joined = Parts()
            for i, j in np.argwhere(differ & (100 * shared >= percent * union)).tolist():
                if joined.join(part[x[i]], part[y[j]]):
                    links.append((keys[x[i]], keys[y[j]]))
        made = [pa.array([link[side] for link in links], pa.binary()) for side in (0, 1)]
        return pa.table(made, ["a", "b"])

    return linked


class _Search:
    """The steps of one search; ``texts`` has the columns id and text."""

    def __init__(self, texts: DataFrame, width: int, percent: int) -> None:
        self.texts, self.width, self.percent = texts, width, percent
        passed = T.StructType([f for f in texts.schema if f.name != "text"])
        longs = T.ArrayType(T.LongType())
        fields = {"key": T.BinaryType(), "n": T.LongType(), "bands": longs, "odd": longs}
        schema = T.StructType([*passed, *[T.StructField(k, v) for k, v in fields.items()]])
        as_bytes = texts.withColumn("text", F.col("text").cast("binary"))
        self.rows = stored(as_bytes.mapInArrow(_over_texts(_sketched, width), schema))
        self.classes = stored(
            self.rows.where(F.col("key").isNotNull())
            .groupBy("key")
            .agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("odd").alias("odd"))
        )
        self.odd = self.classes.select("key", "odd")

    def members(self) -> DataFrame:
        """Classes by bucket, for buckets of several classes, with the bucket's leader."""
        placed = self.classes.select("key", F.explode("bands").alias("bucket"))
        rank = F.xxhash64("key")
        shared = (
            placed.groupBy("bucket")
            .agg(F.min(rank).alias("leader"), F.max(rank).alias("last"))
            .where(F.col("leader") != F.col("last"))
            .select("bucket", "leader")
        )
        return stored(placed.join(shared, "bucket"))

    def with_leaders(self, members: DataFrame) -> DataFrame:
        """Pairs of a class and the leader of a bucket it is in, whose sketches are near."""
        leads = F.xxhash64("key") == F.col("leader")
        leaders = members.where(leads).select("bucket", F.col("key").alias("a"))
        others = members.where(~leads).select("bucket", F.col("key").alias("b"))
        pairs = others.join(leaders, "bucket").select("a", "b").distinct()
        sketches = [self.odd.toDF(side, f"odd_{side}") for side in ("a", "b")]
        near = _differing(F.col("odd_a"), F.col("odd_b")) <= MAX_BITS
        return stored(pairs.join(sketches[1], "b").join(sketches[0], "a").where(near).select("a", "b"))

    def across(self, members: DataFrame, families: DataFrame) -> DataFrame:
        """Pairs of one bucket whose sketches are near though their families differ so far."""
        labelled = members.join(families.toDF("key", "family"), "key", "left").select(
            "bucket", "key", F.coalesce("family", "key").alias("family")
        )
        sizes = labelled.groupBy("bucket", "family").agg(F.count("*").alias("n"))
        several = (
            sizes.groupBy("bucket")
            .agg(
                F.max(F.struct("n", "family")).alias("core"),
                F.sum("n").alias("n"),
                F.count("*").alias("families"),
            )
            .where(F.col("families") > 1)
            .select(
                "bucket", F.col("core.family").alias("core"), (1 + F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")
            )
        )
        rest = stored(labelled.join(several, "bucket").join(self.odd, "key"))
        # What is outside the bucket's largest family meets each block of the bucket in a task of its own.
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        x = rest.where(F.col("family") != F.col("core")).withColumn("block", every).alias("x")
        y = rest.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).alias("y")
        pairs = x.join(
            y,
            (F.col("x.bucket") == F.col("y.bucket"))
            & (F.col("x.block") == F.col("y.block"))
            & (F.col("x.family") != F.col("y.family"))
            & ((F.col("y.family") == F.col("y.core")) | (F.col("x.key") < F.col("y.key")))
            & (_differing(F.col("x.odd"), F.col("y.odd")) <= MAX_BITS),
        ).select(
            F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")
        )
        return stored(pairs.distinct())

    def full_sets(self, pairs: DataFrame) -> DataFrame:
        """(key, held) of all classes in ``pairs``: their sets, read from the texts again."""
        keys = pairs.select("a").union(pairs.select("b")).distinct().toDF("key")
        wanted = stored(keys.join(self.classes.select("key", "id"), "key"))
        ids = wanted.select(F.col("id").alias("wanted")).distinct()
        [small] = fits_broadcast(ids)
        ids = F.broadcast(ids) if small else ids
        texts = self.texts.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
        schema = T.StructType(
            [T.StructField("key", T.BinaryType()), T.StructField("held", T.ArrayType(T.LongType()))]
        )
        sets = texts.select(F.col("text").cast("binary")).mapInArrow(
            _over_texts(_spelled_out, self.width), schema
        )
        # An id may come with several texts, and a text with several rows.
        return stored(sets.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]))

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        both = pairs.join(sets.toDF("b", "held_b"), "b").join(sets.toDF("a", "held_a"), "a")
        shared = F.size(F.array_intersect("held_a", "held_b"))
        union = F.size("held_a") + F.size("held_b") - shared
        return stored(both.where(100 * shared >= self.percent * union).select("a", "b"))

    def within(self, families: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between the parts into which a family has fallen.

        The largest part is the core. What is outside is compared with the whole family, in blocks
        of bounded shingles and sets that count common shingles by matrix products; core is never compared with
        core, and a block gives no more links than it joins parts.
        """
        placed = stored(
            families.toDF("key", "family")
            .join(parts.toDF("key", "part"), "key", "left")
            .join(sets.select("key", F.size("held").cast("long").alias("n")), "key")
            .select("key", "family", F.coalesce("part", "key").alias("part"), "n")
        )
        by_part = placed.groupBy("family", "part").agg(F.count("*").alias("classes"), F.sum("n").alias("n"))
        by_family = (
            by_part.groupBy("family")
            .agg(
                F.max(F.struct("classes", "part", "n")).alias("core"),
                F.sum("n").alias("n"),
                F.sum("classes").alias("classes"),
                F.count("*").alias("parts"),
            )
            .where(F.col("parts") > 1)
        )

        def needed(shingles: Column, classes: Column) -> Column:
            return (1 + F.greatest(shingles / BLOCK_SHINGLES, classes / BLOCK_SETS)).cast("int")

        n, classes = F.col("n"), F.col("classes")
        blocks = by_family.select(
            "family",
            F.col("core.part").alias("core"),
            needed(n - F.col("core.n"), classes - F.col("core.classes")).alias("outside_blocks"),
            needed(n, classes).alias("family_blocks"),
        )
        rows = stored(placed.join(blocks, "family")).join(sets, "key")
        place = F.xxhash64("key")

        def dealt(rows: DataFrame, outside: bool) -> DataFrame:
            own, other = ("outside", "family") if outside else ("family", "outside")
            every = F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)
            return rows.select(
                "family",
                F.pmod(place, F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block"),
                F.explode(every).alias(f"{other}_block"),
                F.lit(outside).alias("outside"),
                "key",
                "part",
                "held",
            )

        both = dealt(rows.where(F.col("part") != F.col("core")), True).unionByName(dealt(rows, False))
        found = both.groupBy("family", "outside_block", "family_block").applyInArrow(
            _linked(self.percent), "a binary, b binary"
        )
        return stored(found)

    def grouped(self) -> DataFrame:
        """(key, component_id) of every class."""
        members = self.members()
        near = self.with_leaders(members)
        families = components(near)
        cross = self.across(members, families)
        if not cross.isEmpty():
            near = near.union(cross)
            families = components(near)
        sets = self.full_sets(near)
        links = self.confirmed(near, sets)
        joined = components(links)
        more = self.within(families, joined, sets)
        if not more.isEmpty():
            joined = components(links.union(more))
        labelled = self.classes.select("key", "id").join(joined.toDF("key", "component"), "key", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "key"))
        smallest = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
        return stored(labelled.join(smallest, "component").select("key", "component", "component_id"))


def near_duplicates(
    documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Per document: shingles of its set, smallest id of its component, and whether it is that one."""
    texts = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return _placed(texts, width, percent).select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _placed(texts: DataFrame, width: int, percent: int) -> DataFrame:
    search = _Search(texts, width, percent)
    full, empty = F.col("key").isNotNull(), F.col("key").isNull()
    rows = search.rows.drop("bands", "odd")
    # Documents without words would all meet in one partition of the join.
    alone = rows.where(empty).withColumn("component", F.col("key")).withColumn("component_id", F.col("id"))
    return rows.where(full).join(search.grouped(), "key").unionByName(alone)


def without_near_duplicates(
    documents: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each component, that with the smallest id; columns as before.

    A null id is the largest; of different texts with that id, or without one, a hash decides. Rows
    equal in id and text count as one document, of which one row stays. Documents without words stay.
    """
    columns = documents.columns
    packed = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row"),
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{text}`").alias("text"),
    )
    same = F.md5(
        F.concat_ws(
            "|", F.col("id").isNull().cast("string"), F.col("id").cast("string"), F.col("text")
        )
    )
    placed = _placed(packed.select("id", same.alias("same"), "text"), width, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "same")).getField("same")
    of_words = placed.where(F.col("component").isNotNull()).groupBy("component").agg(first.alias("same"))
    empty = placed.where(F.col("component").isNull())
    kept = of_words.select("same").union(empty.select("same")).distinct()
    once = F.row_number().over(Window.partitionBy("same").orderBy("same"))
    return (
        packed.select("row", same.alias("same"))
        .join(kept, "same")
        .withColumn("copy", once)
        .where(F.col("copy") == 1)
        .select("row.*")
    )
