"""Spelling variants: words one letter apart, by pairs of trie nodes.

All words are sorted and the nodes of their trie are numbered, once from the front and once, over
the reversed words, from the back. A word without its letter at some place is a pair of two numbers:
the node of what is before and the node of what is behind. Two words that differ by one replaced
letter have such a pair in common; a word with one letter more shares the pair of its skipped letter
with the shorter word cut in two at that place. The numbers are exact names of prefixes and suffixes,
so the pairs that meet are exactly the neighbours, each at one pair: a letter within a run of equal
ones is only skipped at the first.

Scale. Words are counted with partial sums where they are read; only distinct words go on. They are
dealt by ranges of the alphabet; a node that reaches across ranges gets its number from the ends of
the ranges before. A pair can only meet another if both its nodes are shared by two words, which the
neighbours in either order tell, so of the places of a word few are sent. A group of equal pairs holds
one word per letter of the alphabet and one shorter word at most; from its two largest members each
member reads its candidate, so no group is paired out. A word's length costs one number per place.

Defined results: null texts have no words, a null id is an empty one in the hash that injects slips;
repeated rows count again; of equally frequent forms the smallest in code-point order is taken; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import stored

LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 6
LEAST_COUNT = 5
# A form is at least so many times as frequent as its variant.
RATIO = 5
# One of so many words loses a letter, by the hash of document and word.
SLIP_EVERY = 199
# Words of a range of the alphabet.
RANGE_WORDS = 50_000


def word_counts(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    slip_every: int | None = SLIP_EVERY,
) -> DataFrame:
    """(word, n) of the words of all texts, after slips, that are long and frequent enough.

    Only A-Z are lower-cased. ``slip_every`` None leaves the words as they are.
    """
    # A slip shortens, so no shorter run can become a word.
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))
    own = F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))
    words = documents.select(own.alias("own"), F.explode(runs).alias("word"))
    if slip_every is not None:
        drawn = words.withColumn("h", F.crc32(F.concat(F.col("own"), F.lit(":"), F.col("word")).cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        slipped = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = drawn.select(F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("word")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _shared(a: bytes, b: bytes) -> int:
    """How many bytes two words begin with in common."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    return next(i for i in range(size) if a[i] != b[i])


def _shared_ahead(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every word but the first, what it shares with the word before."""
    shared = np.zeros(len(sizes), np.int64)
    active, depth = np.arange(1, len(sizes)), 0
    while len(active):
        active = active[np.minimum(sizes[active], sizes[active - 1]) > depth]
        active = active[data[starts[active] + depth] == data[starts[active - 1] + depth]]
        shared[active] += 1
        depth += 1
    return shared


def _first_with(shared: np.ndarray, sizes: np.ndarray, upto: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word and each depth up to its ``upto``, the first word with the same beginning.

    ``shared[0]`` is what the first word shares with the word before the range; that deep a beginning
    starts at a word before, which ``carried`` gives per depth as a number below 0. Returned flat.
    """
    bounds = np.concatenate(([0], np.cumsum(upto + 1)))
    firsts = np.zeros(bounds[-1], np.int64)
    active, depth = np.arange(len(sizes)), 0
    while len(active):
        new = shared[active] < depth
        start = np.maximum.accumulate(np.where(new, active, -1))
        if depth < len(carried):
            start = np.where(start < 0, carried[depth], start)
        told = active[upto[active] >= depth]
        firsts[bounds[told] + depth] = start[upto[active] >= depth]
        depth += 1
        active = active[sizes[active] >= depth]
    return firsts, bounds


def _words_of(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words in order of their letters, one byte each, as a list and flat; and their old places."""
    words = [word.encode("latin-1") for word in table.column("word").to_pylist()]
    order = sorted(range(len(words)), key=words.__getitem__)
    words = [words[i] for i in order]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    return words, data, sizes, np.array(order, np.int64)


def _summary(table: pa.Table) -> pa.Table:
    """One row for a range: its words and letters, its ends, and where the beginnings of the last start."""
    words, data, sizes, _ = _words_of(table)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    shared = _shared_ahead(data, starts, sizes)
    upto = np.full(len(words), -1)
    upto[-1] = sizes[-1]
    firsts, _ = _first_with(shared, sizes, upto, np.zeros(1, np.int64))
    # The node of a beginning is named by its first word and its depth: the letters before that word,
    # one more per word for the empty beginning, and the depth.
    names = (starts + np.arange(len(words)))[firsts] + np.arange(len(firsts))
    return pa.table(
        {
            "part": [table.column("part")[0].as_py()],
            "words": [len(words)],
            "nodes": [int(sizes.sum()) + len(words)],
            "first": [words[0]],
            "last": [words[-1]],
            "names": [names.tolist()],
            "whole": [_shared(words[0], words[-1])],
        },
        schema=pa.schema(
            [("part", pa.int32()), ("words", pa.int64()), ("nodes", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("names", pa.list_(pa.int64())), ("whole", pa.int64())]
        ),
    )


def _carried(ranges: list[Any]) -> dict[int, tuple[int, int, int, int, list[int]]]:
    """Per range: words and nodes before it, what its ends share with its neighbours, and the names of
    the beginnings that its first word shares with the word before. One short pass over the ranges."""
    found: dict[int, tuple[int, int, int, int, list[int]]] = {}
    words = nodes = 0
    names: list[int] = []
    for i, part in enumerate(ranges):
        ahead = _shared(ranges[i - 1]["last"], part["first"]) if i else -1
        behind = _shared(part["last"], ranges[i + 1]["first"]) if i + 1 < len(ranges) else -1
        carried = names[: ahead + 1]
        found[part["part"]] = (words, nodes, ahead, behind, carried)
        own = [nodes + name for name in part["names"]]
        # What all words of the range begin with may have begun before it.
        through = min(ahead, part["whole"]) + 1
        names = carried[:through] + own[through:]
        words += part["words"]
        nodes += part["nodes"]
    return found


NODES = "id bigint, word string, n bigint, source bigint, nodes array<bigint>"


def _numbered(carried: dict) -> Callable[[pa.Table], pa.Table]:
    def numbered(table: pa.Table) -> pa.Table:
        before, nodes, ahead, behind, names = carried[table.column("part")[0].as_py()]
        words, data, sizes, order = _words_of(table)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        shared = _shared_ahead(data, starts, sizes)
        shared[0] = ahead
        # A node is shared by two words as far as its word agrees with a neighbour.
        upto = np.maximum(shared, np.append(shared[1:], behind))
        coded = -2 - np.arange(len(names), dtype=np.int64)
        firsts, bounds = _first_with(shared, sizes, np.maximum(upto, 0), coded)
        depths = np.arange(len(firsts)) - np.repeat(bounds[:-1], np.diff(bounds))
        own = nodes + (starts + np.arange(len(words)))[np.maximum(firsts, 0)] + depths
        given = np.array(names or [0], np.int64)
        found = np.where(firsts < 0, given[np.minimum(np.maximum(-2 - firsts, 0), len(given) - 1)], own)
        rows = table.take(pa.array(order))
        return pa.table(
            {
                "id": pa.array(before + np.arange(len(words))),
                "word": rows.column("word"),
                "n": rows.column("n"),
                "source": rows.column("source"),
                "nodes": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found)),
            }
        )

    return numbered


def trie_nodes(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """Words (word, n, source) with their place ``id`` in code-point order and the numbers of their nodes.

    ``nodes`` has the node of each beginning, from the empty one on, as far as another word shares it.
    Words are distinct and of letters up to U+00FF.
    """
    ranges = max(1, -(-words.count() // range_words))
    dealt = stored(words.repartitionByRange(ranges, "word").withColumn("part", F.spark_partition_id()))
    kinds = "part int, words bigint, nodes bigint, first binary, last binary, names array<bigint>, whole bigint"
    # One row per range.
    told = dealt.groupBy("part").applyInArrow(_summary, kinds).collect()
    carried = _carried(sorted(told, key=lambda row: row["part"]))
    return dealt.groupBy("part").applyInArrow(_numbered(carried), NODES)


def _pairs(words: DataFrame) -> DataFrame:
    """Pairs of nodes around every place of a word at which both are shared with another word.

    ``skips`` says whether the letter there is left out or nothing is, ``first`` that the letter is not
    the one before again.
    """
    size, ahead, behind = F.length("word"), F.size("before"), F.size("behind")
    # Places i with a shared beginning of i letters and a shared end of the rest.
    skipped = F.when(
        F.greatest(F.lit(0), size - behind) <= F.least(size, ahead) - 1,
        F.sequence(F.greatest(F.lit(0), size - behind), F.least(size, ahead) - 1),
    )
    cut = F.when(
        F.greatest(F.lit(0), size - behind + 1) <= F.least(size, ahead - 1),
        F.sequence(F.greatest(F.lit(0), size - behind + 1), F.least(size, ahead - 1)),
    )
    rows = words.withColumns({"skipped": skipped, "cut": cut})
    letter = lambda at: F.substring("word", at, F.lit(1))
    skips = rows.select("*", F.explode("skipped").alias("i")).select(
        F.get("before", F.col("i")).alias("front"),
        F.get("behind", size - F.col("i") - 1).alias("back"),
        "id",
        "n",
        F.lit(True).alias("skips"),
        ((F.col("i") == 0) | (letter(F.col("i") + 1) != letter(F.col("i")))).alias("first"),
    )
    cuts = rows.select("*", F.explode("cut").alias("i")).select(
        F.get("before", F.col("i")).alias("front"),
        F.get("behind", size - F.col("i")).alias("back"),
        "id",
        "n",
        F.lit(False).alias("skips"),
        F.lit(False).alias("first"),
    )
    return skips.unionByName(cuts)


def neighbours(words: DataFrame, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """The numbered words (id, word, n), stored, and of those with near words (id, n_near, best).

    ``best`` is a struct of the count and the negative id of the most frequent near word; of equally
    frequent ones the smallest.
    """
    numbered = stored(trie_nodes(words.select("word", "n", F.lit(None).cast("bigint").alias("source")), range_words))
    turned = numbered.select(F.reverse("word").alias("word"), "n", F.col("id").alias("source"))
    backward = trie_nodes(turned, range_words).select(F.col("source").alias("id"), F.col("nodes").alias("behind"))
    both = numbered.withColumnRenamed("nodes", "before").join(backward, "id")
    member = F.struct("n", (-F.col("id")).alias("minus"), "skips", "first")
    # At most one skipped word per letter and one cut word: an alphabet's worth.
    groups = (
        _pairs(both).groupBy("front", "back").agg(F.sort_array(F.collect_list(member), asc=False).alias("members"))
        .where(F.size("members") > 1)
    )
    rank = lambda m: F.struct(m["n"].alias("n"), m["minus"].alias("minus"))
    of = lambda test: F.transform(F.filter("members", test), rank)
    sides = groups.select(
        "members",
        of(lambda m: m["skips"]).alias("skips"),
        of(lambda m: m["first"]).alias("firsts"),
        of(lambda m: ~m["skips"]).alias("cuts"),
    ).select(
        F.explode("members").alias("m"),
        F.size("skips").alias("n_skips"),
        F.size("firsts").alias("n_firsts"),
        F.size("cuts").alias("n_cuts"),
        F.get("skips", F.lit(0)).alias("top"),
        F.get("skips", F.lit(1)).alias("second"),
        F.get("firsts", F.lit(0)).alias("top_first"),
        F.get("cuts", F.lit(0)).alias("short"),
    )
    other = F.when(F.col("top.minus") == F.col("m.minus"), F.col("second")).otherwise(F.col("top"))
    best = F.when(F.col("m.skips"), F.greatest(other, F.when(F.col("m.first"), F.col("short")))).otherwise(F.col("top_first"))
    near = F.when(
        F.col("m.skips"), F.col("n_skips") - 1 + F.when(F.col("m.first"), F.col("n_cuts")).otherwise(0)
    ).otherwise(F.col("n_firsts"))
    found = (
        sides.select((-F.col("m.minus")).alias("id"), near.cast("long").alias("near"), best.alias("best"))
        .where(F.col("near") > 0)
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    )
    return numbered.select("id", "word", "n"), found


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) of every link (id, form): the end of its chain, found by doubling the steps.

    Forms are at least ``RATIO`` times as frequent, so chains are short and have no rings.
    """
    steps = stored(links.select("id", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        doubled = stored(steps.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not doubled.where("moved").limit(1).count():
            return doubled.select("id", "root")
        steps = doubled.select("id", "root")


def variants(words: DataFrame, ratio: int = RATIO, range_words: int = RANGE_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``words`` (word, n).

    A word's form is its most frequent near word if that is ``ratio`` times as frequent at least; the
    root is the end of the chain of forms, or the word itself.
    """
    numbered, near = neighbours(stored(words), range_words)
    judged = stored(
        numbered.join(near, "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.minus")).alias("form"),
        )
    )
    links = judged.where(F.col("form").isNotNull()).select("id", "form")
    ended = stored(links.join(_roots(links), "id"))
    named = judged.select("id", "word", "n")
    forms = ended.join(named.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n")), "form")
    forms = forms.join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    return judged.drop("form").join(forms.select("id", "form_word", "root_word", "form_n"), "id", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
