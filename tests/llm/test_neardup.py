"""Near-duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest

from aerolag.llm import components, neardup
from tests.llm.conftest import prose


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width):
    """{row: (n, component)} by comparing all pairs; a null id is the largest."""
    sets = [shingles(text, width) for _, text in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    found = []
    for i, (id_, _) in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if find(k) == find(i) and r[0] is not None]
        found.append((id_, len(sets[i]), min(ids, default=None)))
    return sorted(found, key=str)


def edited(pick, text, share):
    return " ".join(prose(pick, 1) if pick.random() < share else w for w in text.split(" "))


def sample():
    pick = random.Random(8)
    vocabulary = prose(pick, 3000).split()
    texts = [prose(pick, pick.randint(5, 200), vocabulary) for _ in range(60)]
    base = prose(pick, 300, vocabulary)
    # Copies at about the threshold from each other: chains, and parts outside the core.
    texts += [edited(pick, base, pick.choice([0.01, 0.03, 0.05, 0.06, 0.08])) for _ in range(60)]
    texts += [edited(pick, texts[i], 0.03) for i in range(0, 40, 3)]
    texts += [None, "", " \n ", "one", "ONE", "two words", "Two  Words", texts[0], texts[0].upper()]
    return texts


@pytest.mark.parametrize("width", [2, 5])
def test_equals_all_pairs(documents, width):
    texts = sample()
    ids = list(range(100, 100 + len(texts)))
    ids[3], ids[-1] = None, 7
    found = neardup.near_duplicates(documents(texts, ids), width=width)
    rows = sorted((tuple(row)[:3] for row in found.collect()), key=str)
    assert rows == brute(list(zip(ids, texts)), width)
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found.collect())


def test_one_document_of_each_group_stays(documents):
    texts = sample() * 2
    ids = list(range(len(texts) // 2)) * 2
    docs = documents(texts, ids)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = {row[0] for row in brute(list(zip(ids, texts)), 5) if row[0] == row[2]}
    found = [row["doc_id"] for row in kept.collect()]
    assert sorted(found) == sorted(expected)


def test_one_document_stays_without_ids_or_with_shared_ones(documents):
    pick = random.Random(12)
    base = prose(pick, 300)
    group = [base + f" {word}" for word in ("one", "two", "three")]
    other = prose(pick, 200)
    for ids in ([None] * 3, [5] * 3, [None, 9, 9]):
        docs = documents([*group, other, other + " x", "", "  ", None], [*ids, 5, None, None, 5, 6])
        kept = neardup.without_near_duplicates(docs).collect()
        assert sum(row["text"] in group for row in kept) == 1
        assert [row["doc_id"] for row in kept if row["text"] in group] == [min((i for i in ids if i), default=None)]
        assert [row["text"] for row in kept if row["text"] and row["text"].startswith(other)] == [other]
        assert sum(not (row["text"] or "").strip() for row in kept) == 3


def test_buckets_in_blocks(documents, monkeypatch):
    """Buckets of several families dealt to many tasks give the same components."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 3)
    texts = sample()
    found = neardup.near_duplicates(documents(texts), width=2)
    rows = sorted((tuple(row)[:3] for row in found.collect()), key=str)
    assert rows == brute(list(enumerate(texts)), 2)


def test_empty_table(documents):
    none = documents(["x"]).where("false")
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.without_near_duplicates(none).count() == 0


def test_odd_sketch_bits_tell_parity():
    random_ = np.random.default_rng(1)
    samples = random_.integers(0, 1 << 32, (2, neardup.SAMPLES), dtype=np.uint32)
    samples[1, :90] = samples[0, :90]
    bits = np.unpackbits(neardup.odd_sketches(samples).view(np.uint8)).reshape(2, -1)
    # Equal samples cancel: only the six that differ are left, twice.
    assert (bits[0] ^ bits[1]).sum() in {12, 10, 8, 6}


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    for few in (components.FEW_LINKS, 0):
        frame = spark.createDataFrame(links, "a bigint, b bigint")
        found = components.components(frame, few).collect()
        assert {r["node"]: r["component"] for r in found} == {
            **{i: 0 for i in range(41)},
            **{100 + i: 100 for i in range(30)},
        }


def test_blocks_of_a_family_link_what_is_outside_the_core(documents, monkeypatch):
    """Many blocks give the same components as one."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 700)
    texts = sample()
    found = neardup.near_duplicates(documents(texts), width=2)
    rows = sorted((tuple(row)[:3] for row in found.collect()), key=str)
    assert rows == brute(list(enumerate(texts)), 2)
