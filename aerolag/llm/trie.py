"""Prefix trie of conversations, in balanced parentheses.

Conversations as sequences of hashed turns are sorted and dealt into shards by ranges of that order. A
shard writes its part of the trie as parentheses in depth-first order, one pair per node. The excess
of opening over closing ones is kept with a tree of block minima, by which the closing parenthesis of
every node is found; it delimits the subtree. Ranks of adjacent pairs "()" count leaves, running sums
count members and saved bytes, and a table of minima gives the smallest member.

The nodes on the path between two neighbouring shards, their spine, belong to both. A shard leaves
them open and tells only what hangs on them directly. Groups of ``FAN`` neighbouring shards then merge
their spines by the same parentheses, those groups merge in turn, until one is left.

Scale. Equal conversations are merged before they are dealt, so a conversation that a third of the log
repeats is one row. The ids of its copies are joined in blocks of a range of ids and hashed as a
stream. Shards hold about ``SHARD_TURNS`` turns; a spine is as long as what two neighbours share. A
conversation is one row of 24 bytes a turn.

Defined results: null roles and texts are empty; turns with equal numbers follow by their hash, those
without a number come first; repeated rows are further turns; rows without a conversation id are left
out; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import stored
from aerolag.operators.joins import lookup_join

# Bytes of a hashed turn.
TURN = 16
# Conversations that are rebuilt on a common one, and the turns they may take from it.
FAMILY = 5
TAKEN = 9
SHARD_TURNS = 50_000
FAN = 64
# Ids of one text block, by their range.
BLOCK_BITS = 12
# Parentheses of a block of the excess.
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
HIGHEST = np.iinfo(np.int64).max


def _turns(turns: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    said = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in (role, text)]
    whole = F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said)
    return turns.select(
        F.col(f"`{id}`").cast("bigint").alias("id"),
        F.struct(
            F.col(f"`{id}`").cast("bigint").alias("id"),
            F.col(f"`{turn}`").cast("bigint").alias("turn"),
            F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * TURN)).alias("hash"),
            F.octet_length(said[1]).cast("bigint").alias("size"),
        ).alias("said"),
    ).where(F.col("id").isNotNull())


def _in_order(said: list[dict]) -> list[dict]:
    return sorted(said, key=lambda t: (t["turn"] is not None, t["turn"] or 0, t["hash"]))


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of each family, on the turns they take from its first one."""
    for batch in batches:
        ids, paths, sizes = [], [], []
        for family, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own: dict[int, list[dict]] = {}
            for said in turns:
                own.setdefault(said["id"], []).append(said)
            own = {id: _in_order(said) for id, said in own.items()}
            for id, said in own.items():
                taken = zlib.crc32(str(id).encode()) % TAKEN
                said = own.get(family, [])[:taken] + said[taken:]
                ids.append(id)
                paths.append(b"".join(t["hash"] for t in said))
                sizes.append([t["size"] for t in said])
        columns = [pa.array(ids, pa.int64()), pa.array(paths, pa.binary()), pa.array(sizes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "path", "sizes"])


SEQUENCES = "id bigint, path binary, sizes array<bigint>"


def rebuilt(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each conversation as its hashed turns and their bytes, rebuilt on the first of its family.

    A conversation c takes the first h turns of conversation ``c - c % FAMILY`` in place of its own
    first h, where h is a hash of c.
    """
    told = _turns(turns, id, turn, role, text)
    gathered = told.groupBy((F.col("id") - F.col("id") % FAMILY).alias("family")).agg(F.collect_list("said").alias("turns"))
    return gathered.mapInArrow(_rebuilt, SEQUENCES)


def sequences(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each conversation as its hashed turns and their bytes, as it stands."""
    told = _turns(turns, id, turn, role, text)
    order = F.struct("said.turn", "said.hash", "said.size")
    gathered = told.groupBy("id").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    return gathered.select("id", F.array_join(F.transform("turns.hash", lambda h: F.hex(h)), "").alias("path"), F.col("turns.size").alias("sizes")).withColumn("path", F.unhex("path"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of all blocks of each name, which come in order; one block is held at a time."""
    name, digest = None, None
    for batch in batches:
        names, ends = [], []
        for own, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own == name:
                digest.update(b"," + block.encode())
                continue
            if name is not None:
                names.append(name)
                ends.append(digest.hexdigest())
            name, digest = own, hashlib.sha256(block.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ends, pa.string())], ["name", "ends"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], ["name", "ends"])


def _distinct(conversations: DataFrame) -> DataFrame:
    """(path, sizes, n, low, ends) of each distinct sequence: its copies, their smallest id, the hash of all."""
    named = stored(conversations.withColumn("name", F.sha2("path", 256)))
    whole = named.groupBy("name").agg(
        F.any_value("path").alias("path"),
        F.any_value("sizes").alias("sizes"),
        F.count("*").alias("n"),
        F.min("id").alias("low"),
    )
    ids = F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string"))
    blocks = named.groupBy("name", F.shiftright("id", BLOCK_BITS).alias("block")).agg(F.array_join(ids, ",").alias("ids"))
    ordered = blocks.repartition("name").sortWithinPartitions("name", "block").select("name", "ids")
    return whole.join(ordered.mapInArrow(_digests, "name string, ends string"), "name").drop("name")


class Parentheses:
    """Balanced parentheses of a tree given by the depths of its nodes in depth-first order.

    ``opens`` has the place of every node's opening parenthesis; ``excess`` counts the open ones after
    each place. ``low`` is a binary tree of the least excess of blocks; block b is at ``leaves + b``.
    """

    def __init__(self, depths: np.ndarray) -> None:
        n = len(depths)
        self.opens = 2 * np.arange(n) - depths
        self.bits = np.zeros(2 * n, bool)
        self.bits[self.opens] = True
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        blocks = -(-2 * n // BLOCK)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(self.leaves * BLOCK, HIGHEST)
        padded[: 2 * n] = self.excess
        self.low = np.full(2 * self.leaves, HIGHEST)
        self.low[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        for level in range(self.leaves.bit_length() - 2, -1, -1):
            at = np.arange(1 << level, 2 << level)
            self.low[at] = np.minimum(self.low[2 * at], self.low[2 * at + 1])
        self._padded = padded

    def _within(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` to the end of its block with an excess of ``goal``, or -1."""
        found = np.full(len(at), -1)
        left = np.arange(len(at))
        at = at.copy()
        while len(left):
            hit = self._padded[at[left]] == goal[left]
            found[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] % BLOCK != 0]
        return found

    def find_close(self) -> np.ndarray:
        """The closing place of each node: the first later one whose excess is one less."""
        goal = self.excess[self.opens] - 1
        after = self.opens + 1
        close = np.full(len(goal), -1)
        # An opening place at the end of its block goes on in the next one.
        inner = np.flatnonzero(after % BLOCK != 0)
        close[inner] = self._within(after[inner], goal[inner])
        open_ = np.flatnonzero(close < 0)
        node = self.leaves + self.opens[open_] // BLOCK
        goal_ = goal[open_]
        rising = np.arange(len(open_))
        while len(rising):
            # Up until a right neighbour reaches the goal, and over to it.
            right = node[rising] + 1
            over = (node[rising] % 2 == 0) & (self.low[np.minimum(right, len(self.low) - 1)] <= goal_[rising])
            node[rising] = np.where(over, right, node[rising] // 2)
            rising = rising[~over]
        sinking = np.flatnonzero(node < self.leaves)
        while len(sinking):
            left = 2 * node[sinking]
            node[sinking] = np.where(self.low[left] <= goal_[sinking], left, left + 1)
            sinking = sinking[node[sinking] < self.leaves]
        close[open_] = self._within((node - self.leaves) * BLOCK, goal_)
        return close

    def pairs_before(self, counted: np.ndarray) -> np.ndarray:
        """How many pairs "()" of the nodes ``counted`` open before each place."""
        alone = np.zeros(len(self.bits), np.int64)
        own = self.opens[counted]
        alone[own] = ~self.bits[own + 1]
        return np.concatenate(([0], np.cumsum(alone)))


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least value of each range, from two overlapping powers of two."""
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        half = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
    found = np.empty(len(begin), values.dtype)
    power = np.frexp((end - begin).astype(np.float64))[1] - 1
    for k, table in enumerate(tables):
        own = power == k
        found[own] = np.minimum(table[begin[own]], table[end[own] - (1 << k)])
    return found


@dataclass
class Nodes:
    """Nodes in depth-first order with what belongs to each directly; ``key`` names those of spines."""

    depth: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)
    saved: list[int] = field(default_factory=list)
    ends: list[str | None] = field(default_factory=list)
    key: list[bytes | None] = field(default_factory=list)
    left: list[bool] = field(default_factory=list)
    right: list[bool] = field(default_factory=list)

    def add(self, depth: int, size: int) -> None:
        for name, value in (
            ("depth", depth), ("size", size), ("n", 0), ("low", int(HIGHEST)), ("children", 0), ("leaves", 0),
            ("saved", 0), ("ends", None), ("key", None), ("left", False), ("right", False),
        ):
            getattr(self, name).append(value)


SOLVED = pa.schema(
    [
        ("part", pa.int32()), ("place", pa.int64()), ("spine", pa.bool_()), ("left", pa.bool_()), ("right", pa.bool_()),
        ("key", pa.binary()), ("parent_key", pa.binary()), ("size", pa.int64()), ("conv_id", pa.int64()),
        ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ]
)
KINDS = """part int, place bigint, spine boolean, `left` boolean, `right` boolean, key binary, parent_key binary,
  size bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,
  n_leaves bigint, saved_tokens bigint, ends_sha256 string"""
RESULT = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def _parents(depth: np.ndarray) -> np.ndarray:
    """The last node before each that is one less deep; -1 for the root."""
    parents = np.full(len(depth), -1)
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(int(depth.max()) + 2))
    above = order[: cuts[1]]
    for d in range(1, len(cuts) - 1):
        own = order[cuts[d] : cuts[d + 1]]
        parents[own] = above[np.searchsorted(above, own) - 1]
        above = own
    return parents


def solved(nodes: Nodes, part: int, bottom: bool) -> pa.Table:
    """Totals of every subtree. Rows of the spine tell instead what hangs on them directly.

    ``bottom`` is whether leaves are to be counted here; merged spines have been counted below.
    """
    depth = np.array(nodes.depth, np.int64)
    spine = np.array(nodes.left) | np.array(nodes.right)
    trie = Parentheses(depth)
    close = trie.find_close()
    first = np.arange(len(depth))
    end = first + (close - trie.opens + 1) // 2

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[end] - sums[first]

    n = total(np.array(nodes.n, np.int64))
    low = _least(np.array(nodes.low, np.int64), first, end)
    size = np.array(nodes.size, np.int64)
    leaves = total(np.array(nodes.leaves, np.int64))
    if bottom:
        pairs = trie.pairs_before(np.flatnonzero(~spine))
        leaves += pairs[close + 1] - pairs[trie.opens]
    # What a node saves itself is known once all its members are.
    saved = total(np.array(nodes.saved, np.int64) + np.where(spine, 0, (n - 1) * size))
    parents = _parents(depth)
    inner = np.flatnonzero((parents >= 0) & ~spine)
    children = np.array(nodes.children, np.int64) + np.bincount(parents[inner], minlength=len(depth))
    for values in (n, leaves, saved):
        # The totals of spine nodes go down to what is on no deeper spine node.
        deeper = np.flatnonzero(spine & (parents >= 0))
        values[spine] -= np.bincount(parents[deeper], values[deeper], len(depth)).astype(np.int64)[spine] if len(deeper) else 0
    keys = nodes.key
    known = (parents >= 0) & ~spine & ~spine[parents]
    waits = (parents >= 0) & ~spine & spine[parents]
    return pa.table(
        {
            "part": np.full(len(depth), part, np.int32),
            "place": first,
            "spine": spine,
            "left": np.array(nodes.left),
            "right": np.array(nodes.right),
            "key": keys,
            "parent_key": [keys[p] if w else None for p, w in zip(parents, waits)],
            "size": size,
            "conv_id": low,
            "depth": depth,
            "parent_conv_id": pa.array(low[parents], mask=~known),
            "n_convs": n,
            "n_children": children,
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends_sha256": nodes.ends,
        },
        schema=SOLVED,
    )


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two paths begin with in common."""
    size = min(len(a), len(b)) // TURN
    low, high = 0, size
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[: half * TURN] == b[: half * TURN] else (low, half - 1)
    return low


def _shard(places: dict[int, tuple[int, int, int]]) -> Callable[[pa.Table], pa.Table]:
    """``places`` has the number of each part, and the turns its ends share with its neighbours."""

    def shard(table: pa.Table) -> pa.Table:
        number, ahead, behind = places[table.column("part")[0].as_py()]
        rows = sorted(table.select(["path", "sizes", "n", "low", "ends"]).to_pylist(), key=lambda row: row["path"])
        nodes, before, path_of = Nodes(), None, []
        for row in rows:
            path, sizes = row["path"], row["sizes"]
            begin = 0 if before is None else _shared(before, path) + 1
            for depth in range(begin, len(sizes) + 1):
                nodes.add(depth, sizes[depth - 1] if depth else 0)
                path_of.append(path)
            nodes.n[-1], nodes.low[-1], nodes.ends[-1] = row["n"], row["low"], row["ends"]
            before = path
        for i in range(min(ahead + 1, len(nodes.depth))):
            nodes.left[i] = True
        goal, i = behind, len(nodes.depth) - 1
        last = nodes.depth[-1] + 1
        while i >= 0 and goal >= 0:
            if nodes.depth[i] < last:
                last = nodes.depth[i]
                if last <= goal:
                    nodes.right[i] = True
            i -= 1
            if last == 0:
                break
        for i, (depth, left, right) in enumerate(zip(nodes.depth, nodes.left, nodes.right)):
            if left or right:
                nodes.key[i] = hashlib.blake2b(path_of[i][: depth * TURN], digest_size=16).digest()
        return solved(nodes, number, bottom=True)

    return shard


def _merged(fan: int) -> Callable[[pa.Table], pa.Table]:
    def merged(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["group"]).to_pylist(), key=lambda row: (row["part"], row["place"]))
        first, last = rows[0]["part"], rows[-1]["part"]
        nodes, at = Nodes(), {}
        for row in rows:
            if row["key"] not in at:
                at[row["key"]] = len(nodes.depth)
                nodes.add(row["depth"], row["size"])
                nodes.key[-1] = row["key"]
            i = at[row["key"]]
            nodes.n[i] += row["n_convs"]
            nodes.low[i] = min(nodes.low[i], row["conv_id"])
            nodes.children[i] += row["n_children"]
            nodes.leaves[i] += row["n_leaves"]
            nodes.saved[i] += row["saved_tokens"]
            nodes.ends[i] = nodes.ends[i] or row["ends_sha256"]
            nodes.left[i] |= row["left"] and row["part"] == first
            nodes.right[i] |= row["right"] and row["part"] == last
        return solved(nodes, first // fan, bottom=False)

    return merged


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, fan: int = FAN) -> DataFrame:
    """One row per distinct beginning of the conversations (id, path, sizes) of :func:`sequences`.

    conv_id is the smallest member; parent_conv_id that of the beginning one turn shorter; n_convs
    counts members, n_children and n_leaves nodes; saved_tokens sums over the subtree the bytes of
    last turns that all but one member repeat; ends_sha256 hashes the ids that end here.
    """
    whole = stored(_distinct(conversations))
    turns = whole.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    dealt = stored(whole.repartitionByRange(shards, "path").withColumn("part", F.spark_partition_id()))
    # One row per shard.
    told = sorted(dealt.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last")).collect())
    places = {}
    for i, own in enumerate(told):
        ahead = _shared(told[i - 1]["last"], own["first"]) if i else -1
        behind = _shared(own["last"], told[i + 1]["first"]) if i + 1 < len(told) else -1
        places[own["part"]] = (i, ahead, behind)
    level = stored(dealt.groupBy("part").applyInArrow(_shard(places), KINDS))
    found, groups = [level.where(~F.col("spine"))], len(told)
    while groups > 1:
        groups = -(-groups // fan)
        spines = level.where("spine").withColumn("group", (F.col("part") / fan).cast("int"))
        level = stored(spines.groupBy("group").applyInArrow(_merged(fan), KINDS))
        found.append(level.where(~F.col("spine")))
    nodes = reduce(DataFrame.unionByName, found)
    parent: Column = F.col("parent_conv_id")
    if len(found) > 1:
        above = reduce(DataFrame.unionByName, found[1:]).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
        nodes = lookup_join(nodes, above, ["parent_key"])
        parent = F.coalesce("parent_conv_id", "above")
    ends = F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    return nodes.withColumn("parent_conv_id", parent).withColumn("ends_sha256", ends).select(*RESULT)
