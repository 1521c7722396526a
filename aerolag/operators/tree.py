"""Entropy decision tree, grown one level at a time for all nodes together.

The training table is first reduced to distinct rows with their counts. Its
columns are categories, so that table is bounded by the product of their domains
(a few million rows for the nine encoded columns) however many flights there
are. Each level is then one chain of groupings over it, with no per-node jobs and
no rows in the driver.

Counts give entropies as ``n H = n log2 n - sum(c log2 c)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolag.operators.joins import fits_broadcast, is_small, lookup_join, measure
from aerolag.schemas import ATTRIBUTES, LABEL
from aerolag.session import checkpointed

ROOT = "root"
# Pseudo attribute with a single value: its statistics are those of the node.
WHOLE_NODE = -1
# Digits kept when entropies are compared, so that sums in another order still tie.
DIGITS = 10


# Largest tree that rows walk by themselves.
WALK_NODES = 20_000

# Stands for a null value in node ids.
NULL_VALUE = "?"


@dataclass(frozen=True)
class TreeRules:
    """When a node stops; every limit binds every node."""

    # Defaults of the training job.
    min_rows: int = 100
    min_entropy: float = 1.0
    max_level: int = 4


def compact(rows: DataFrame, attributes: list[str] = ATTRIBUTES, label: str = LABEL) -> DataFrame:
    """Distinct rows with their count ``n``; copies combine before the shuffle."""
    return rows.groupBy(*attributes, label).agg(F.count("*").alias("n"))


def at_root(counted: DataFrame) -> DataFrame:
    """Counted rows tagged with the root node and no attribute used."""
    return counted.withColumns(
        {"node_id": F.lit(ROOT), "used": F.array().cast("array<int>")}
    )


def attribute_counts(
    frontier: DataFrame, attributes: list[str] = ATTRIBUTES, label: str = LABEL
) -> DataFrame:
    """Rows per (node, unused attribute, value, label), and per (node, label) as ``WHOLE_NODE``."""
    pairs = [F.lit(WHOLE_NODE), F.lit(0)]
    for index, name in enumerate(attributes):
        pairs += [F.lit(index), F.col(name)]
    stacked = frontier.select(
        "node_id",
        "used",
        F.col(label).alias("label"),
        "n",
        F.stack(F.lit(len(attributes) + 1), *pairs).alias("attr", "value"),
    )
    return (
        stacked.where(~F.array_contains("used", F.col("attr")))
        .groupBy("node_id", "attr", "value", "label")
        .agg(F.sum("n").alias("n"))
    )


def value_key(value: Column) -> Column:
    """How a value is written in node ids."""
    return F.coalesce(value.cast("string"), F.lit(NULL_VALUE))


def _n_log_n(count: str):
    return F.col(count) * F.log2(count)


def attribute_entropies(counts: DataFrame) -> DataFrame:
    """Per (node, attribute): rows, H(label | attribute) and the node's most frequent label.

    For ``WHOLE_NODE`` the entropy is H(label). The smaller label wins a tie. A node
    has at most as many counts as attributes x values x labels, so all groupings
    from here on share one exchange by node.
    """
    per_value = counts.repartition("node_id").groupBy("node_id", "attr", "value").agg(
        F.sum("n").alias("rows"),
        F.sum(_n_log_n("n")).alias("inner"),
        F.max(F.struct("n", (-F.col("label")).alias("minus_label"))).alias("top"),
    )
    return per_value.groupBy("node_id", "attr").agg(
        F.sum("rows").alias("n"),
        (F.sum(_n_log_n("rows") - F.col("inner")) / F.sum("rows")).alias("entropy"),
        (-F.max("top")["minus_label"]).alias("mode"),
    )


def information_gain(
    rows: DataFrame, attributes: list[str] = ATTRIBUTES, label: str = LABEL
) -> DataFrame:
    """Per attribute: H(label), H(label | attribute) and their difference."""
    counts = attribute_counts(at_root(compact(rows, attributes, label)), attributes, label)
    # All rows of a node are together already, so carrying its entropy along shuffles nothing.
    of_node = F.max(F.when(F.col("attr") == WHOLE_NODE, F.col("entropy"))).over(
        Window.partitionBy("node_id")
    )
    return (
        attribute_entropies(counts)
        .withColumn("h_y", of_node)
        .where(F.col("attr") != WHOLE_NODE)
        .select("attr", "h_y", F.col("entropy").alias("h_y_x"), (F.col("h_y") - F.col("entropy")).alias("gain"))
    )


def best_split(gains: DataFrame) -> DataFrame:
    """The attribute of highest gain, the lowest index on a tie."""
    best = F.max(F.struct(F.round("gain", DIGITS).alias("gain"), (-F.col("attr")).alias("minus_attr")))
    return gains.agg(best.alias("best")).select(
        (-F.col("best.minus_attr")).alias("attr"), F.col("best.gain").alias("gain")
    )


def level_nodes(
    frontier: DataFrame,
    level: int,
    rules: TreeRules,
    attributes: list[str] = ATTRIBUTES,
    label: str = LABEL,
) -> DataFrame:
    """The nodes of one level, each with its split attribute or marked as a leaf."""
    entropies = attribute_entropies(attribute_counts(frontier, attributes, label))
    whole = F.col("attr") == WHOLE_NODE
    nodes = entropies.groupBy("node_id").agg(
        F.max(F.when(whole, F.col("n"))).alias("n"),
        F.max(F.when(whole, F.col("entropy"))).alias("h_y"),
        F.max(F.when(whole, F.col("mode"))).alias("prediction"),
        F.min(
            F.when(~whole, F.struct(F.round("entropy", DIGITS).alias("entropy"), "attr"))
        )["attr"].alias("best"),
    )
    is_leaf = (
        F.col("best").isNull()
        | (F.round("h_y", DIGITS) < rules.min_entropy)
        | (F.col("n") < rules.min_rows)
        | F.lit(level >= rules.max_level)
    )
    return nodes.select(
        "node_id",
        (F.substring_index("node_id", "#", level) if level else F.lit(None).cast("string")).alias("parent_id"),
        F.lit(level).alias("level"),
        F.when(~is_leaf, F.col("best")).alias("split_attr"),
        F.substring_index("node_id", "#", -1).try_cast("int").alias("split_value"),
        "n",
        "h_y",
        is_leaf.alias("is_leaf"),
        "prediction",
    )


def splits_of(nodes: DataFrame) -> DataFrame:
    return nodes.where(~F.col("is_leaf")).select("node_id", "split_attr")


def descend(
    frontier: DataFrame,
    splits: DataFrame,
    attributes: list[str] = ATTRIBUTES,
    small: bool | None = None,
) -> DataFrame:
    """Rows of the split nodes, moved to the child of their value; leaves drop out."""
    value = F.get(F.array(*attributes), F.col("split_attr"))
    carried = [name for name in frontier.columns if name not in (*attributes, "node_id", "used")]
    return lookup_join(frontier, splits, ["node_id"], "inner", small).select(
        *attributes,
        *carried,
        F.concat("node_id", F.lit("#"), value_key(value)).alias("node_id"),
        F.array_append("used", F.col("split_attr")).alias("used"),
    )


def grow_tree(
    rows: DataFrame,
    rules: TreeRules = TreeRules(),
    attributes: list[str] = ATTRIBUTES,
    label: str = LABEL,
) -> DataFrame:
    """The tree as a table of nodes.

    A null value has a child of its own, written ``NULL_VALUE`` in ids. Each attribute is used once per path, so there are at most as many levels as
    attributes. ``split_attr`` is the index of the attribute a node splits on,
    ``split_value`` the value that leads into it, ``prediction`` its most frequent
    label, inner nodes included.
    """
    return grow_counted(checkpointed(compact(rows, attributes, label)), rules, attributes, label)


def grow_counted(
    counted: DataFrame,
    rules: TreeRules = TreeRules(),
    attributes: list[str] = ATTRIBUTES,
    label: str = LABEL,
) -> DataFrame:
    """:func:`grow_tree` over the stored result of :func:`compact`."""
    frontier = at_root(counted)
    levels = []
    for level in range(len(attributes) + 1):
        nodes = checkpointed(level_nodes(frontier, level, rules, attributes, label))
        levels.append(nodes)
        splits = splits_of(nodes)
        [size] = measure(splits)
        if size["rows"] == 0:
            break
        frontier = checkpointed(descend(frontier, splits, attributes, is_small(size)))
    return reduce(DataFrame.unionByName, levels)


def walk_table(nodes: DataFrame) -> DataFrame:
    """The nodes as one row with one array, in order of their ids, each with the places of its children.

    For trees of at most ``WALK_NODES`` nodes.
    """
    place = F.row_number().over(Window.orderBy("node_id")) - 1
    placed = nodes.select("node_id", "parent_id", "prediction", "split_attr", place.alias("place"))
    child = F.struct(F.substring_index("node_id", "#", -1).alias("value"), "place")
    children = placed.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("node_id"))
    listed = placed.join(children.agg(F.collect_list(child).alias("kids")), "node_id", "left")
    node = F.struct(
        "place",
        "node_id",
        "prediction",
        "split_attr",
        F.col("kids.value").alias("values"),
        F.col("kids.place").alias("children"),
    )
    return listed.agg(F.array_sort(F.collect_list(node)).alias("tree"))


def _walked(nodes: DataFrame, rows: DataFrame, attributes: list[str]) -> DataFrame:
    """Rows with their node, each walked down the tree by itself: one scan, and no join."""
    depth = nodes.agg(F.max("level")).first()[0] or 0
    cells = F.array(*attributes)

    def step(state: Column, _: Column) -> Column:
        node = F.get(state["tree"], state["at"])
        value = value_key(F.get(state["cells"], node["split_attr"]))
        found = F.array_position(node["values"], value).cast("int")
        below = F.when(found > 0, F.get(node["children"], found - 1))
        return F.struct(state["tree"].alias("tree"), state["cells"].alias("cells"), F.coalesce(below, state["at"]).alias("at"))

    # The tree is one value of the plan, read once; it comes along as a reference.
    carried = rows.select("*", walk_table(nodes).scalar().alias("_tree"))
    start = F.struct(F.col("_tree").alias("tree"), cells.alias("cells"), F.lit(0).alias("at"))
    levels = F.sequence(F.lit(1), F.lit(depth)) if depth else F.array().cast("array<int>")
    end = F.aggregate(levels, start, step, lambda state: F.get(state["tree"], state["at"]))
    return carried.withColumn("_node", end).select(*rows.columns, "_node.node_id", "_node.prediction")


def score_tree(
    nodes: DataFrame,
    rows: DataFrame,
    attributes: list[str] = ATTRIBUTES,
    small: bool | None = None,
) -> DataFrame:
    """Rows with the node they reach and its prediction.

    A value that no child stands for stops at the last node reached. A tree of at most ``WALK_NODES``
    nodes is walked by each row for itself; beyond, every level is one shuffled lookup of the edges.
    """
    if small is None:
        [small] = fits_broadcast(nodes, max_rows=WALK_NODES)
    if small:
        return _walked(nodes, rows, attributes)
    edges = nodes.where(F.col("level") > 0).select(
        F.col("parent_id").alias("node_id"),
        F.substring_index("node_id", "#", -1).alias("_value"),
        F.col("node_id").alias("_child"),
        F.col("split_attr").alias("_child_attr"),
        F.col("prediction").alias("_child_prediction"),
    )
    at_root_node = F.when(F.col("level") == 0, F.struct("node_id", "prediction", "split_attr"))
    depth, root = nodes.agg(F.max("level"), F.max(at_root_node)).first()
    scored = rows.withColumns(
        {
            "node_id": F.lit(root["node_id"]),
            "prediction": F.lit(root["prediction"]),
            "_attr": F.lit(root["split_attr"]).cast("int"),
        }
    )
    for _ in range(depth):
        # A row that has stopped has no attribute, and must not pass for one with a missing value.
        own = F.when(F.col("_attr").isNotNull(), value_key(F.get(F.array(*attributes), F.col("_attr"))))
        at_value = scored.withColumn("_value", own)
        found = lookup_join(at_value, edges, ["node_id", "_value"], "left", small)
        scored = found.select(
            *rows.columns,
            F.coalesce("_child", "node_id").alias("node_id"),
            F.coalesce("_child_prediction", "prediction").alias("prediction"),
            F.col("_child_attr").alias("_attr"),
        )
    return scored.drop("_attr")


NODES = """node_id string, parent_id string, level int, split_attr int, split_value int, n bigint, h_y double,
  is_leaf boolean, prediction int"""


def save_tree(nodes: DataFrame, path: str) -> None:
    """Write the table of nodes."""
    nodes.write.mode("overwrite").parquet(path)


def load_tree(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of :func:`save_tree`, ready to score with."""
    return spark.read.schema(NODES).parquet(path)


def tree_text(nodes: DataFrame) -> DataFrame:
    """One line per node, parents before children, indented by level."""
    return nodes.orderBy("node_id").select(
        "node_id", F.concat(F.repeat(F.lit("|---"), F.col("level")), "node_id").alias("line")
    )


def label_entropy(rows: DataFrame, label: str = LABEL) -> DataFrame:
    """Entropy of the label in bits."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n")
    return counts.agg(
        total.alias("n"), (F.log2(total) - F.sum(_n_log_n("n")) / total).alias("entropy")
    )


def mode_by(rows: DataFrame, keys: list[str], label: str = LABEL) -> DataFrame:
    """Most frequent label per group, the smallest on a tie."""
    counts = rows.groupBy(*keys, label).agg(F.count("*").alias("n"))
    top = F.max(F.struct("n", (-F.col(label)).alias("minus_label")))
    return counts.groupBy(*keys).agg(top.alias("top")).select(
        *keys, (-F.col("top.minus_label")).alias("mode"), F.col("top.n").alias("n")
    )
