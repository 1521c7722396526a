"""Winnowing against all windows."""

import random
import re

from aerolag.llm import decontaminate
from tests.llm.conftest import prose


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items):
    words, hit, found = split(text), set(), set()
    for name, item in items:
        said = split(item)
        n = min(10, len(said))
        windows = {tuple(said[i : i + n]) for i in range(len(said) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(words), len(hit), sorted(found)


def sample():
    pick = random.Random(2)
    few = prose(pick, 30).split()
    items = [(i, prose(pick, pick.randint(10, 60))) for i in range(20)]
    items += [(50, "Tiny"), (51, "two words"), (52, ""), (53, None), (None, prose(pick, 12)), (3, prose(pick, 15))]
    items += [(60, prose(pick, 40, few[:2])), (61, prose(pick, 9))]
    texts = [None, "", "...", "tiny", prose(pick, 300, few[:2])]
    for i in range(60):
        _, item = pick.choice(items)
        words = (item or "x").upper().split()
        a = pick.randint(0, max(0, len(words) - 9))
        cut = words[a : a + pick.randint(8, 25)]
        texts.append(prose(pick, pick.randint(0, 40)) + ", " + "; ".join(cut) + "! " + prose(pick, pick.randint(0, 40)))
    texts += [prose(pick, 12, few) for _ in range(5)] + [texts[9]]
    return texts, items


def test_equals_all_windows_in_one_block_and_in_many(spark, documents):
    texts, items = sample()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 150):
        judged = decontaminate.contamination(documents(texts), benchmark, block_words=block_words)
        for row in judged.collect():
            hits = row["hits"]
            assert (hits["n_words"], hits["n_hit"], hits["items"]) == brute(texts[row["doc_id"]], items)
            assert sum(s["end"] - s["start"] for s in hits["spans"]) == hits["n_hit"]


def test_only_clean_documents_stay(spark, documents):
    texts, items = sample()
    docs = documents(texts)
    kept = decontaminate.decontaminated(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(texts) if not brute(t, items)[1]}


def test_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    none = benchmark.where("false")
    assert decontaminate.decontaminated(documents(["a b c"]), none).count() == 1
    assert decontaminate.decontaminated(documents(["a b c"]).where("false"), benchmark).count() == 0


def test_long_items_are_cut_into_segments_without_loss(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 25)
    pick = random.Random(5)
    item = prose(pick, 200)
    words = item.split()
    texts = [" ".join(words[i : i + 10]) for i in range(0, 191, 7)]
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    judged = decontaminate.contamination(documents(texts), benchmark)
    assert {row["hits"]["n_hit"] for row in judged.collect()} == {10}
