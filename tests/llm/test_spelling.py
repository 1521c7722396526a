"""Spelling variants against all pairs of words, and the counting rule against plain Python."""

import re
import zlib
from collections import Counter

import pytest

from aerolag.llm import spelling


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_pairs(counts: dict[str, int], ratio: int = spelling.RATIO) -> set[tuple]:
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    rows = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        own = form[word]
        rows.add((word, own, root, n, len(near[word]), None if own is None else counts[own]))
    return rows


def found(spark, counts: dict[str, int], range_words: int) -> set[tuple]:
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return {tuple(row) for row in spelling.variants(words, range_words=range_words).collect()}


@pytest.mark.parametrize("range_words", [7, 60, 10_000])
def test_equals_all_pairs(spark, range_words):
    import random

    draw = random.Random(range_words)
    counts = {"a" * k: 5 ** (k % 4) for k in range(1, 9)} | {"é": 7, "éé": 3, "ÿa": 900, "zz": 1}
    for _ in range(250):
        counts["".join(draw.choice("abé") for _ in range(draw.randint(1, 7)))] = draw.choice([1, 2, 10, 10, 60, 400])
    assert found(spark, counts, range_words) == by_pairs(counts)


def test_long_words_chains_and_a_word_alone(spark):
    stem = "lorem" * 400
    counts = {stem: 625, stem[:-1]: 125, stem[:-2]: 25, stem[:-3]: 5, "x" + stem: 5, "apart": 9}
    assert found(spark, counts, 2) == by_pairs(counts)


def test_no_words(spark):
    assert found(spark, {}, 10) == set()


def plain_counts(rows) -> dict[str, int]:
    counts = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def test_counts_of_words(spark):
    text = "Wandering WANDERING Éclairer éclairer short, sevenly naïvely×÷ 12wandering "
    rows = [(i, text * (i % 3 + 1)) for i in range(400)] + [(None, text), (7, None), (8, ""), (7, text)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n", "'x' as word")
    counted = {row["word"]: row["n"] for row in spelling.word_counts(documents).collect()}
    assert counted == plain_counts(rows)
    assert "wanderig" in counted or any(word not in text.lower() for word in counted)
