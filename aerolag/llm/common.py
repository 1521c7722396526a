"""What several operators share: tables, stored steps, and hashed words.

Words are hashed a piece of a batch at a time over its bytes: a polynomial of each word comes from
one running sum over the piece, so no Python object is made per word.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from aerolag.session import checkpoint_folder

WHITE_SPACE = b" \t\n\x0b\x0c\r"
# Bytes hashed in one go; running sums of a piece stay in a core's cache.
PIECE = 1 << 18
# Texts handled together, in bytes; one longer text is handled alone.
CHUNK = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Folders written in each open :func:`discarding`, the innermost last.
_OPEN: list[list[str]] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared folder of ``spark.checkpoint.dir``, not made yet."""
    path = f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    for folders in _OPEN[-1:]:
        folders.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder of ``spark.checkpoint.dir``, and read again.

    Lost executors cost only the tasks at hand: what was written is not computed again.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what operators have stored in between, but for what :func:`kept` names.

    Results are lazy and read those tables, so they must be written before the end. Without this the
    tables stay in the shared folder, as a result that outlives the call needs them.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for folder in _OPEN.pop():
            path = hadoop.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame) -> DataFrame:
    """:func:`stored`, for a result that outlives the :func:`discarding` around it."""
    _OPEN.append([])
    try:
        return stored(df)
    finally:
        _OPEN.pop()


def save_model(spark: SparkSession, model: object, path: str) -> None:
    """Write a fitted model as a table of one row, for the next shards of a corpus."""
    spark.createDataFrame([(pickle.dumps(model),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> object:
    """The model of :func:`save_model`. It is unpickled, so only own files should be loaded."""
    [row] = spark.read.schema("model binary").parquet(path).collect()
    return pickle.loads(bytes(row["model"]))


def spare_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column of ``df`` is called so."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def separators(keep: bytes) -> np.ndarray:
    """Which of the 256 bytes end a word."""
    found = np.zeros(256, dtype=bool)
    found[list(keep)] = True
    return found


# Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACES = separators(WHITE_SPACE)
# All of ASCII but digits and lower-case letters, to be applied after LOWER.
NOT_ALPHANUMERIC = separators(
    bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits so that every input bit moves every output bit (Murmur3's finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of the base of the word polynomial and of its inverse, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))


_POWERS = Powers()


def _hash_piece(piece: np.ndarray, ends_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and hashes of the words of a piece that begins and ends outside words."""
    _POWERS.reach(len(piece) + 1)
    edges = np.flatnonzero(ends_word[1:] != ends_word[:-1]) + 1
    if not ends_word[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    terms = (piece.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(piece)]
    sums = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * _POWERS.down[starts])


class Words(NamedTuple):
    """Words of several texts: text i has the words bounds[i] to bounds[i + 1].

    ``starts`` and ``ends`` are places in ``data``, the lower-cased texts with a blank after each;
    text i begins at offsets[i].
    """

    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def words_in(texts: list[bytes | None], ends_word: np.ndarray) -> Words:
    """Words of UTF-8 texts, A-Z lower-cased, for all texts together. None has no words."""
    joined = b" ".join([text or b"" for text in texts]) + b" "
    data = LOWER[np.frombuffer(joined, dtype=np.uint8)]
    breaks = ends_word[data]
    lengths = np.fromiter((len(text or b"") + 1 for text in texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    pieces, at = [], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        # A piece ends with a byte that ends a word; the last byte always does.
        tail = breaks[at:stop][::-1].argmax()
        if breaks[stop - 1 - tail]:
            stop -= int(tail)
        else:
            stop += int(breaks[stop:].argmax()) + 1
        starts, ends, hashes = _hash_piece(data[at:stop], breaks[at:stop])
        pieces.append((starts + at, ends + at, hashes))
        at = stop
    starts, ends, hashes = (np.concatenate(column) for column in zip(*pieces))
    return Words(np.searchsorted(starts, offsets), hashes, starts, ends, offsets, data)


def hashed_words(
    texts: list[bytes | None], ends_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bounds, hashes, starts and offsets of :func:`words_in`."""
    found = words_in(texts, ends_word)
    return found.bounds, found.hashes, found.starts, found.offsets


def runs_hashed(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``hashes[starts[i]:ends[i]]``, each from two places of one running sum."""
    _POWERS.reach(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _POWERS.up[: len(hashes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts])


def in_chunks(texts: list[bytes | None], limit: int = CHUNK) -> Iterator[list[bytes | None]]:
    """Consecutive texts, together of about ``limit`` bytes; never splits a text."""
    chunk: list[bytes | None] = []
    held = 0
    for text in texts:
        size = len(text or b"")
        if chunk and held + size > limit:
            yield chunk
            chunk, held = [], 0
        chunk.append(text)
        held += size
    if chunk:
        yield chunk
