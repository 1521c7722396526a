"""Tree rules and invariants on small tables, against a recursive brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerolag.operators import tree

ATTRIBUTES = ["a", "b", "c"]
SCHEMA = "a int, b int, c int, y int"


def entropy(labels):
    n = len(labels)
    return -sum(k / n * math.log2(k / n) for k in Counter(labels).values())


def mode(labels):
    return min(Counter(labels).items(), key=lambda item: (-item[1], item[0]))[0]


def brute(rows, rules, node="root", level=0, free=(0, 1, 2)):
    """Nodes as {id: (n, split, leaf, prediction)}."""
    labels = [row[3] for row in rows]
    n, h = len(rows), entropy(labels)
    stop = n < rules.min_rows or level >= rules.max_level
    if not free or round(h, 10) < rules.min_entropy or stop:
        return {node: (n, None, True, mode(labels))}

    def remaining(attr):
        groups = {}
        for row in rows:
            groups.setdefault(row[attr], []).append(row[3])
        return round(sum(len(g) / n * entropy(g) for g in groups.values()), 10)

    split = min(free, key=lambda attr: (remaining(attr), attr))
    nodes = {node: (n, split, False, mode(labels))}
    for value in {row[split] for row in rows}:
        part = [row for row in rows if row[split] == value]
        left = tuple(attr for attr in free if attr != split)
        name = tree.NULL_VALUE if value is None else value
        nodes |= brute(part, rules, f"{node}#{name}", level + 1, left)
    return nodes


def sample(seed, n=400):
    chance = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = (chance.randint(1, 3) for _ in range(3))
        rows.append((a, b, c, chance.choice([a, b, c, chance.randint(1, 5)])))
    return rows


RULES = [
    tree.TreeRules(min_rows=20, min_entropy=1.0, max_level=2),
    tree.TreeRules(min_rows=30, min_entropy=0.5, max_level=3),
    tree.TreeRules(min_rows=100, min_entropy=0.0, max_level=0),
]


@pytest.mark.parametrize("rules", RULES)
def test_tree_equals_brute_force(spark, rules):
    rows = sample(3)
    nodes = tree.grow_tree(spark.createDataFrame(rows, SCHEMA), rules, ATTRIBUTES, "y").collect()
    found = {r["node_id"]: (r["n"], r["split_attr"], r["is_leaf"], r["prediction"]) for r in nodes}
    assert found == brute(rows, rules)
    sizes = {r["node_id"]: r["n"] for r in nodes}
    children = Counter()
    for r in nodes:
        if r["parent_id"]:
            children[r["parent_id"]] += r["n"]
    assert all(children[r["node_id"]] == r["n"] for r in nodes if not r["is_leaf"])
    assert sizes["root"] == len(rows)


def test_nulls_have_nodes_of_their_own(spark):
    rows = [(None if i % 3 else a, b, None if i % 5 == 0 else c, y) for i, (a, b, c, y) in enumerate(sample(9))]
    frame = spark.createDataFrame(rows, SCHEMA)
    nodes = tree.grow_tree(frame, RULES[1], ATTRIBUTES, "y")
    found = nodes.collect()
    assert len({r["node_id"] for r in found}) == len(found)
    expected = brute(rows, RULES[1])
    assert {r["node_id"]: r["n"] for r in found} == {name: n for name, (n, *_) in expected.items()}
    leaves = {r["node_id"]: r["n"] for r in found if r["is_leaf"]}
    scored = tree.score_tree(nodes, frame, ATTRIBUTES)
    assert {r["node_id"]: r["count"] for r in scored.groupBy("node_id").count().collect()} == leaves


def test_copies_of_all_rows_give_the_same_tree(spark):
    def shape(rows, min_rows):
        rules = tree.TreeRules(min_rows=min_rows, min_entropy=0.5, max_level=2)
        nodes = tree.grow_tree(spark.createDataFrame(rows, SCHEMA), rules, ATTRIBUTES, "y")
        return {(r["node_id"], r["split_attr"], r["prediction"]) for r in nodes.collect()}

    assert shape(sample(3), 20) == shape(sample(3) * 7, 140)


@pytest.mark.parametrize("small", [True, False])
def test_every_row_reaches_a_leaf(spark, small):
    rows = spark.createDataFrame(sample(5), SCHEMA)
    nodes = tree.grow_tree(rows, RULES[0], ATTRIBUTES, "y")
    scored = tree.score_tree(nodes, rows, ATTRIBUTES, small)
    leaves = {r["node_id"]: r["n"] for r in nodes.where("is_leaf").collect()}
    reached = {r["node_id"]: r["count"] for r in scored.groupBy("node_id").count().collect()}
    assert reached == leaves


def test_unseen_value_stops_at_the_last_node(spark):
    rows = spark.createDataFrame(sample(5), SCHEMA)
    nodes = tree.grow_tree(rows, RULES[0], ATTRIBUTES, "y")
    strange = spark.createDataFrame([(9, 9, 9)], "a int, b int, c int")
    row = tree.score_tree(nodes, strange, ATTRIBUTES).first()
    root = nodes.where("level = 0").first()
    assert (row["node_id"], row["prediction"]) == ("root", root["prediction"])


def test_entropy_mode_and_ties(spark):
    def rows(labels):
        return spark.createDataFrame([(1, 1, 1, y) for y in labels], SCHEMA)

    assert tree.label_entropy(rows([1, 1, 2, 2]), "y").first()["entropy"] == 1.0
    assert tree.label_entropy(rows([1, 1, 1]), "y").first()["entropy"] == 0.0
    assert tree.mode_by(rows([3, 3, 7, 7]), ["a"], "y").first()["mode"] == 3
    same = spark.createDataFrame([(v, v, 1, v) for v in (1, 2, 1, 2)], SCHEMA)
    gains = tree.information_gain(same, ATTRIBUTES, "y")
    assert tree.best_split(gains).first()["attr"] == 0
    assert min(row["gain"] for row in gains.collect()) >= -1e-12


def test_text_lists_parents_first(spark):
    nodes = tree.grow_tree(spark.createDataFrame(sample(3), SCHEMA), RULES[0], ATTRIBUTES, "y")
    lines = [row["line"] for row in tree.tree_text(nodes).collect()]
    assert lines[0] == "root" and lines[1].startswith("|---root#")


def test_rows_walk_a_small_tree_without_a_join(spark, tmp_path):
    draw = random.Random(8)
    names = [*ATTRIBUTES, "y"]
    data = [[draw.choice([None, 1, 2, 3]) for _ in ATTRIBUTES] for _ in range(1500)]
    rows = spark.createDataFrame([(*r, (r[0] or 0) + (r[1] or 0)) for r in data], ", ".join(f"{n} int" for n in names))
    nodes = tree.grow_tree(rows, tree.TreeRules(min_rows=20, min_entropy=0.1), ATTRIBUTES, "y")
    tree.save_tree(nodes, str(tmp_path / "t"))
    loaded = tree.load_tree(spark, str(tmp_path / "t"))
    assert loaded.dtypes == nodes.dtypes
    unseen = rows.union(spark.createDataFrame([(9,) * len(names)], rows.schema))
    walked = tree.score_tree(loaded, unseen, ATTRIBUTES)
    joined = tree.score_tree(nodes, unseen, ATTRIBUTES, small=False)
    assert sorted(map(str, walked.collect())) == sorted(map(str, joined.collect()))
    plan = walked._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0] and nodes.count() > 20
    root = nodes.where("level = 0").withColumn("split_attr", F.lit(None).cast("int"))
    assert tree.score_tree(root, rows, ATTRIBUTES).select("node_id").distinct().collect() == [("root",)]
