"""Exact ranks and splits over whole tables without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.operators.joins import LOOKUP_BYTES, LOOKUP_ROWS, fits_broadcast, lookup_join
from aerolag.session import checkpointed

# A split places rows by the first PREFIX hexadecimal digits of their hash first.
PREFIX = 4
# Copies one task writes when a group of identical rows is expanded.
CHUNK = 100_000


def dense_codes(df: DataFrame, names: list[str]) -> DataFrame:
    """Per column, its distinct values with their position in sorted order, from 0.

    One pass serves all columns and gives (name, value, code). The values are range
    partitioned; a position is that within the partition plus the sizes of the
    partitions before it, counted from the first value of the column. The
    partitioned values are written out first, because two evaluations may draw
    different ranges.
    """
    pairs = [
        F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value"))
        for name in names
    ]
    values = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    ranged = checkpointed(
        values.repartitionByRange("name", "value").withColumn("_part", F.spark_partition_id())
    )
    # As many rows as partitions times columns.
    sizes = ranged.groupBy("name", "_part").agg(F.count("*").alias("_size"))
    before = (
        Window.partitionBy("name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "name", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("name", "_part").orderBy("value"))
    return ranged.join(F.broadcast(offsets), ["name", "_part"]).select(
        "name", "value", (F.col("_offset") + within - 1).cast("int").alias("code")
    )


def encode(df: DataFrame, codes: DataFrame, aliases: dict[str, str], max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``df`` with the code of each column under its alias; unknown values get -1.

    Vocabularies of up to ``max_rows`` values are broadcast; for larger ones ``df`` is shuffled, and read once
    more to find hot values.
    """
    rows = df
    tables = {
        name: codes.where(F.col("name") == name).select(
            F.col("value").alias(name), F.col("code").alias(alias)
        )
        for name, alias in aliases.items()
    }
    small = fits_broadcast(*tables.values(), max_rows=max_rows, max_bytes=LOOKUP_BYTES)
    for (name, table), fits in zip(tables.items(), small):
        df = lookup_join(df, table, [name], "left", fits, rows.select(name))
    return df.withColumns(
        {alias: F.coalesce(F.col(alias), F.lit(-1)) for alias in aliases.values()}
    )


def one_hot(df: DataFrame, names: list[str], codes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``dummies`` (size, indices): the places that are 1 of one sparse row over all columns.

    Each column has a place per value in sorted order but its first; a null, an unseen value and the
    first have none. The columns follow each other. A row holds at most one number per column,
    however many values there are; the driver learns the sizes of the vocabularies only.
    """
    codes = checkpointed(dense_codes(df, names)) if codes is None else codes
    sizes = vocabulary_sizes(codes)
    aliases = {name: f"_place_{name}" for name in names}
    coded = encode(df, codes, aliases)
    places, offset = [], 0
    for name, alias in aliases.items():
        places.append(F.when(F.col(alias) > 0, F.col(alias) - 1 + offset))
        offset += max(0, sizes.get(name, 0) - 1)
    dummies = F.struct(F.lit(offset).alias("size"), F.array_compact(F.array(*places)).alias("indices"))
    return coded.withColumn("dummies", dummies).drop(*aliases.values())


def vocabulary_sizes(codes: DataFrame) -> dict[str, int]:
    """How many values each column of a code table has."""
    return {row["name"]: row["n"] for row in codes.groupBy("name").agg(F.count("*").alias("n")).collect()}


def expand(counted: DataFrame, count: str) -> DataFrame:
    """Rows repeated by the column ``count``. Large groups are cut into chunks and spread first."""
    columns = [name for name in counted.columns if name != count]
    n = F.col(count)

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        copies = F.sequence(F.lit(1).cast("long"), times)
        return rows.select(*columns, F.explode(copies).alias("_copy")).drop("_copy")

    last_chunk = ((n - 1) / CHUNK).cast("long")
    chunks = counted.where(n > CHUNK).select(
        *columns, n, F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("_chunk")
    )
    in_chunk = F.least(F.lit(CHUNK).cast("long"), n - F.col("_chunk") * CHUNK)
    return repeated(counted.where((n > 0) & (n <= CHUNK)), n).unionByName(
        repeated(chunks.repartition(*columns, "_chunk"), in_chunk)
    )


def split_exact(df: DataFrame, train_of_ten: int = 9) -> DataFrame:
    """Rows with ``split`` train or test, exactly ``n // 10 * train_of_ten`` of them for training.

    Rows are ordered by a hash of their content and each run of ten gives its
    first ``train_of_ten`` to training; the incomplete last run goes to testing.
    Equal rows are counted, not moved, and share out over both sides. Positions
    come from totals per hash bucket and a running count within each bucket.
    """
    text = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    counted = checkpointed(
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_n"))
        .withColumn("_hash", F.md5(F.concat_ws("|", *text)))
        .withColumn("_bucket", F.substring("_hash", 1, PREFIX))
    )
    totals = counted.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    # At most 16 ** PREFIX rows, whatever the table.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    n = totals.agg(F.sum("_size")).first()[0] or 0
    running = Window.partitionBy("_bucket").orderBy("_hash").rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = counted.join(F.broadcast(offsets), "_bucket").withColumn(
        "_upto", F.col("_offset") + F.sum("_n").over(running)
    )

    def train_until(position: Column) -> Column:
        """Training rows among the first ``position`` rows."""
        whole = F.least(position, F.lit(n // 10 * 10).cast("long"))
        runs = F.floor(whole / 10)
        return runs * train_of_ten + F.least(whole - runs * 10, F.lit(train_of_ten).cast("long"))

    train = train_until(F.col("_upto")) - train_until(F.col("_upto") - F.col("_n"))
    sides = placed.withColumn("_train", train).select(
        *df.columns,
        F.stack(
            F.lit(2), F.lit("train"), F.col("_train"), F.lit("test"), F.col("_n") - F.col("_train")
        ).alias("split", "_times"),
    )
    return expand(sides, "_times")
