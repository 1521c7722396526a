"""Snapshots against a plain comparison of prefixes."""

import random

from aerolag.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, own string"


def plain(rows):
    """Rendered texts by conversation id of the conversations that are no prefix of another."""
    turns = {}
    for conv, turn, role, text in set(rows):
        key = (conv, None) if conv is not None else (None, (turn, role, text))
        turns.setdefault(key, []).append((turn is not None, turn or 0, role or "user", text or ""))
    said = {key: [x[2:] for x in sorted(found)] for key, found in turns.items()}
    kept = []
    for key, mine in said.items():
        longer = any(len(o) > len(mine) and o[: len(mine)] == mine for o in said.values())
        copy = any(
            o == mine and k != key and ((k[0] is None, k[0] or 0, str(k[1])) < (key[0] is None, key[0] or 0, str(key[1])))
            for k, o in said.items()
        )
        if not longer and not copy:
            text = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in mine)
            kept.append((key[0], len(mine), text))
    return sorted(kept, key=str)


def sample():
    pick = random.Random(2)
    rows = []
    for conv in range(40):
        opening = pick.choice(["hi", "hello"])
        said = [("user", opening)] + [(pick.choice(["user", "assistant"]), pick.choice("abc")) for _ in range(pick.randint(0, 5))]
        rows += [(conv, t, role, text) for t, (role, text) in enumerate(said)]
        for snapshot in range(pick.randint(0, 2)):
            rows += [(100 + conv * 3 + snapshot, t, role, text) for t, (role, text) in enumerate(said[: snapshot + 1])]
    rows += [rows[0], (500, None, None, None), (500, 1, "user", "x"), (None, 1, "user", "alone"), (None, 2, "user", "alone"), (None, 1, "user", "hi")]
    return rows + [(501, 1, "b", "y"), (501, 1, "a", "z")]


def test_equals_plain_comparison(spark):
    rows = sample()
    turns = spark.createDataFrame([(*row, "x") for row in rows], SCHEMA).repartition(4)
    found = chat.rendered(chat.maximal(turns))
    assert sorted((tuple(row) for row in found.collect()), key=str) == plain(rows)


def test_empty_table(spark):
    assert chat.maximal(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_of_any_type(spark):
    rows = [("a", 0, "user", "x"), ("b", 0, "user", "x"), ("b", 1, "assistant", "y"), (None, 0, "user", "z"), ("", 0, "user", "w")]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    assert {row["conv_id"] for row in chat.maximal(turns).collect()} == {"b", None, ""}


def test_very_long_texts_and_conversations(spark):
    long = "x y " * 300_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, "assistant", ""), (3, 0, "user", long + "z")]
    rows += [(4, t, "user", str(t)) for t in range(3000)] + [(5, t, "user", str(t)) for t in range(2999)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(3)
    found = {row["conv_id"]: row for row in chat.rendered(chat.maximal(turns)).collect()}
    assert sorted(found) == [2, 3, 4]
    assert long + "<|im_end|>" in found[2][-1] or any(long in str(value) for value in found[2])
