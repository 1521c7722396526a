"""Chat formatting with collapse of cumulative snapshots.

Systems that log a conversation after every turn leave snapshots: conversations that are a prefix of
longer ones. Each turn gets a hash of all turns up to it, rolled from the one before; the last hash
of a conversation and its length name the whole. A conversation is a snapshot if a longer one has
the same hash after as many turns, a copy if an equally long one with a smaller id has. Anti-joins
remove both, and what is left is rendered with a template.

Scale. The joins are between names, not conversations, and names are made unique before they are
joined, so neither a first turn nor a conversation that a third of the log shares is a hot key. A
conversation is gathered in one row, since it becomes one text.

Defined results: a turn without a conversation id is a conversation of its own; equal rows are one
turn; turns with equal numbers follow by role and text, those without a number come first; a null
text is empty and a null role is "user"; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import stored

# Fixed values of the template: what stands before the role, after it, and after the text.
OPENING, BETWEEN, CLOSING = "<|im_start|>", "\n", "<|im_end|>\n"


def _gathered(turns: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: key, id, its turns in order and the hash after each."""
    said = turns.select(
        F.col(f"`{id}`").alias("id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("user")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    # Turns without an id stay apart by what they say.
    own = F.when(F.col("id").isNull(), F.xxhash64("said.turn", "said.role", "said.text"))
    gathered = (
        said.withColumn("own", own)
        .groupBy("id", "own")
        .agg(F.sort_array(F.collect_set("said")).alias("turns"))
    )

    def rolled(done: Column, said: Column) -> Column:
        last = F.coalesce(F.element_at(done, -1), F.lit(0).cast("long"))
        return F.concat(done, F.array(F.xxhash64(last, said["role"], said["text"])))

    empty = F.array().cast("array<bigint>")
    return gathered.withColumn(
        "hashes",
        F.aggregate(
            "turns", empty, lambda done, said: F.when(F.size(done) == 0, F.array(F.xxhash64(said["role"], said["text"]))).otherwise(rolled(done, said))
        ),
    )


def maximal(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Conversations that are no prefix of another: their id, and turns as an array of structs."""
    gathered = stored(_gathered(turns, id, turn, role, text))
    length, last = F.size("hashes"), F.element_at("hashes", -1)
    named = gathered.select("id", "own", length.alias("length"), last.alias("hash"))
    prefixes = (
        gathered.select(F.posexplode(F.slice("hashes", 1, length - 1)).alias("at", "hash"))
        .select((F.col("at") + 1).alias("length"), "hash")
        .distinct()
    )
    # One conversation of each name: the smallest id, or one of those without an id.
    whole = named.groupBy("length", "hash").agg(F.min("id").alias("id"), F.min("own").alias("own"))
    longest = whole.join(prefixes, ["length", "hash"], "left_anti")
    # Ids may be of any type: a missing one is told apart by its flag, not by a value.
    key = F.xxhash64(F.col("id").isNull(), F.col("id"), F.col("own"))
    kept = longest.select(F.when(F.col("id").isNull(), key).otherwise(F.xxhash64(F.lit(False), "id")).alias("key"))
    return (
        gathered.withColumn("key", F.when(F.col("id").isNull(), key).otherwise(F.xxhash64(F.lit(False), "id")))
        .join(kept, "key", "left_semi")
        .select(F.col("id").alias(id), "turns")
    )


def rendered(conversations: DataFrame, id: str = "conv_id") -> DataFrame:
    """One text per conversation of :func:`maximal`."""
    parts = F.transform(
        "turns",
        lambda said: F.concat(
            F.lit(OPENING), said["role"], F.lit(BETWEEN), said["text"], F.lit(CLOSING)
        ),
    )
    return conversations.select(
        F.col(id), F.size("turns").cast("long").alias("n_turns"), F.array_join(parts, "").alias("text")
    )
