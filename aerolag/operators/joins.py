"""Lookup joins that hold when the dimension grows and when keys are hot.

A dimension is broadcast only after a count shows it is small. Beyond that the
join shuffles, and hot keys are salted: their facts spread over ``SALTS``
partitions and their dimension rows are repeated once per salt. At most
``HOT_SHARE`` keys can each hold more than ``1 / HOT_SHARE`` of the rows, so the
list of hot keys is itself small by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from aerolag.session import checkpointed

# Largest dimension that is broadcast: its rows, and the bytes of their text form.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# The same for lookups of few short columns, which take some 200 bytes of memory a row.
LOOKUP_ROWS = 1_000_000
LOOKUP_BYTES = 128 << 20

# A key is hot when it holds more than one part in HOT_SHARE of the fact rows.
HOT_SHARE = 1000
SALTS = 200


def measure(*frames: DataFrame) -> list[Row]:
    """Rows and bytes of text of each frame, all in one job."""
    sizes = []
    for position, frame in enumerate(frames):
        text = F.concat_ws("", *[F.col(name).cast("string") for name in frame.columns])
        sizes.append(
            frame.agg(
                F.lit(position).alias("position"),
                F.count("*").alias("rows"),
                F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"),
            )
        )
    return sorted(reduce(DataFrame.union, sizes).collect())


def is_small(size: Row, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def fits_broadcast(
    *dims: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Whether each frame has at most ``max_rows`` rows and ``max_bytes`` bytes of text."""
    return [is_small(size, max_rows, max_bytes) for size in measure(*dims)]


def hot_keys(fact: DataFrame, on: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``1 / share`` of the rows: never more than ``share`` of them."""
    counts = fact.groupBy(*on).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(F.col("_rows") * share > total).select(*on)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    small: bool | None = None,
    key_source: DataFrame | None = None,
    share: int = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``fact`` to ``dim`` on equal columns ``on``; ``how`` is left or inner.

    ``small`` is the outcome of :func:`fits_broadcast` when the caller has it
    already. ``key_source`` may name a cheaper frame with the same key columns to
    find hot keys in; any choice gives the same rows, only their placement differs.
    """
    if small is None:
        [small] = fits_broadcast(dim)
    if small:
        return fact.join(F.broadcast(dim), on, how)
    source = fact if key_source is None else key_source
    # Written out once: the list is tiny, and both sides below read it.
    hot = F.broadcast(checkpointed(hot_keys(source, on, share)).withColumn("_hot", F.lit(True)))
    # Rows without a key match nothing, yet would all meet in one partition.
    keyless = reduce(Column.__or__, [F.col(name).isNull() for name in on])
    # The salt comes from the row itself, so a repeated task gives the same salt.
    # Exact copies share one; adaptive execution splits their partition.
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    salted_fact = (
        fact.join(hot, on, "left")
        .withColumn("_salt", F.when(F.col("_hot") | keyless, spread).otherwise(0))
        .drop("_hot")
    )
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_dim = (
        dim.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.coalesce(every_salt, F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted_fact.join(salted_dim, [*on, "_salt"], how).drop("_salt")
