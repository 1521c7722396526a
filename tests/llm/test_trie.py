"""The prefix trie against a plain one, at several shard sizes; parentheses against a stack."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from aerolag.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, path string"


def plain_rebuilt(rows):
    own = {}
    for id, turn, role, text in rows:
        if id is not None:
            said = (role or "", text or "")
            digest = hashlib.sha256(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).digest()[:16]
            own.setdefault(id, []).append(((turn is not None, turn or 0, digest), said))
    own = {id: [said for _, said in sorted(turns)] for id, turns in own.items()}
    for id in own:
        h = zlib.crc32(str(id).encode()) % 9
        yield id, own.get(id - id % 5, [])[:h] + own[id][h:]


def plain_trie(conversations):
    members, ended = {}, {}
    for id, said in conversations:
        ended.setdefault(tuple(said), []).append(id)
        for depth in range(len(said) + 1):
            members.setdefault(tuple(said[:depth]), []).append(id)
    rows = set()
    for node, ids in members.items():
        under = [other for other in members if other[: len(node)] == node]
        children = [other for other in under if len(other) == len(node) + 1]
        childless = [u for u in under if not any(o[: len(u)] == u and len(o) > len(u) for o in under)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in under if u)
        ends = ",".join(map(str, sorted(ended.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(ids), len(node), parent, len(ids), len(children), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def log(count, seed):
    draw = random.Random(seed)
    rows = []
    for id in range(count):
        if draw.random() < 0.2:
            continue
        for turn in range(draw.choice([1, 2, 3, 9, 12])):
            rows.append((id, turn, draw.choice(["user", None]), draw.choice(["a", "bé", None, ""])))
    rows += [(id, turn, "user", f"long {turn}") for id in (600, 601, 700, 705, 5000) for turn in range(40)]
    rows += [(8, 3, "user", "again"), (8, 3, "user", "again"), (9, None, "x", "first"), (None, 1, "user", "lost"), (-7, 0, "a", "b")]
    return rows


@pytest.mark.parametrize("shard_turns,fan", [(10**6, 64), (60, 64), (25, 2), (9, 3)])
def test_equals_a_plain_trie(spark, shard_turns, fan):
    rows = log(60, shard_turns)
    turns = spark.createDataFrame([(*row, 1, "p") for row in rows], SCHEMA).repartition(5)
    result = trie.prefix_trie(trie.rebuilt(turns), shard_turns, fan)
    assert result.columns == trie.RESULT
    got = [tuple(row) for row in result.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(list(plain_rebuilt(rows)))


def test_conversations_as_they_stand(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "a")]
    turns = spark.createDataFrame([(*row, 1, "p") for row in rows], SCHEMA)
    said = [(1, [("u", "a"), ("u", "b")]), (2, [("u", "a"), ("u", "b")]), (3, [("u", "a")])]
    assert {tuple(r) for r in trie.prefix_trie(trie.sequences(turns)).collect()} == plain_trie(said)


def test_empty_table_and_many_copies(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.rebuilt(turns)).count() == 0
    copies = spark.range(20_000).selectExpr("id * 5 AS conv_id", "0L AS turn", "'u' AS role", "'same' AS text")
    rows = [tuple(r) for r in trie.prefix_trie(trie.sequences(copies)).collect()]
    ids = ",".join(str(5 * i) for i in range(20_000))
    none = hashlib.sha256(b"").hexdigest()
    assert set(rows) == {
        (0, 0, None, 20_000, 1, 1, 4 * 19_999, none),
        (0, 1, 0, 20_000, 0, 1, 4 * 19_999, hashlib.sha256(ids.encode()).hexdigest()),
    }


@pytest.mark.parametrize("seed", range(6))
def test_parentheses_close_where_a_stack_says(seed):
    draw = np.random.default_rng(seed)
    depths = [0]
    for _ in range(draw.integers(0, 900)):
        depths.append(int(draw.integers(max(1, depths[-1] - 40 * (draw.random() < 0.1) - 1), depths[-1] + 2)))
    depths = np.array(depths)
    found = trie.Parentheses(depths)
    stack, expected = [], np.zeros(len(depths), int)
    node = 0
    for place, opening in enumerate(found.bits):
        if opening:
            stack.append(node)
            node += 1
        else:
            expected[stack.pop()] = place
    assert not stack and np.array_equal(found.find_close(), expected)
