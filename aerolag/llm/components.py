"""Connected components: in one task while the links are few, by alternating stars beyond."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.llm.common import stored

# Links that one task joins in memory, counted before.
FEW_LINKS = 250_000


class Parts:
    """Disjoint sets of comparable nodes; the top of a set is its smallest node."""

    def __init__(self) -> None:
        self.above: dict = {}

    def top(self, node):
        above = self.above
        path = []
        while (higher := above.setdefault(node, node)) != node:
            path.append(node)
            node = higher
        for passed in path:
            above[passed] = node
        return node

    def join(self, a, b) -> bool:
        """Whether ``a`` and ``b`` were apart."""
        a, b = self.top(a), self.top(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _joined(kind: pa.DataType):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts.join(a, b)
        nodes = list(parts.above)
        tops = [parts.top(node) for node in nodes]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(tops, kind)], ["node", "component"])

    return joined


def components(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(node, component), stored, of every node of ``links`` (a, b); the component is its smallest node.

    Null ends and links of a node to itself are ignored; a table without links gives no rows.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
            F.col("a") != F.col("b")
        )
    )
    if edges.count() > few:
        return _by_stars(edges.distinct())
    kind = edges.schema["a"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("component", kind)])
    arrow = pa.int64() if isinstance(kind, T.LongType) else pa.binary()
    return stored(edges.coalesce(1).mapInArrow(_joined(arrow), schema))


def _by_stars(edges: DataFrame) -> DataFrame:
    """Every round connects the larger neighbours of each node to its smallest one, then the smaller
    ones; the rounds needed grow with the logarithm of the nodes. A node's neighbours are never
    gathered: the smallest is an aggregate, joined back.
    """
    before = None
    while True:
        edges = stored(edges)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return stored(nodes.union(tops.distinct()))
        before = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = stored(
            both.join(least, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .where(F.col("b") != F.col("low"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = small.union(least).distinct()
