"""Hashed words against plain splitting."""

import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolag.llm import bilstm, decontaminate, license, neardup, pii, quality, substring, toxicity
from aerolag.llm.common import (
    NOT_ALPHANUMERIC,
    SPACES,
    discarding,
    hashed_words,
    in_chunks,
    kept,
    load_model,
    new_folder,
    runs_hashed,
    save_model,
    stored,
    words_in,
)
from aerolag.session import checkpoint_folder


def plain(text, pattern):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(pattern, lowered)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9é \t\n\x0b\x00.-", max_size=40)), min_size=1, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for breaks, pattern in (
        (SPACES, "[^\x20\x09-\x0d]+"),
        (NOT_ALPHANUMERIC, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"),
    ):
        bounds, hashes, _, _ = hashed_words([None if t is None else t.encode() for t in texts], breaks)
        known = {}
        for i, text in enumerate(texts):
            words = plain(text, pattern)
            assert len(words) == bounds[i + 1] - bounds[i]
            for word, value in zip(words, hashes[bounds[i] : bounds[i + 1]].tolist()):
                assert known.setdefault(word, value) == value
        assert len(set(known.values())) == len(known)


def test_long_words_and_pieces():
    texts = [b"x" * 700_000 + b" y " + b"ab " * 200_000, b"y"]
    bounds, hashes, _, _ = hashed_words(texts, SPACES)
    assert bounds.tolist() == [0, 200_002, 200_003]
    assert hashes[1] == hashes[-1] and len(set(hashes.tolist())) == 3
    found = words_in([b" one two"], SPACES)
    assert found.starts.tolist() == [1, 5] and found.ends.tolist() == [4, 8]


def test_runs_have_the_hash_of_their_words():
    pick = random.Random(1)
    words = np.array([pick.getrandbits(63) for _ in range(5)] * 2, np.uint64)
    first = runs_hashed(words, np.array([0, 5, 1]), np.array([3, 8, 4]))
    assert first[0] == first[1] != first[2]


def test_chunks_keep_order_and_long_texts_whole():
    texts = [b"a" * 5, None, b"b" * 50, b"", b"c"]
    assert [t for chunk in in_chunks(texts, 10) for t in chunk] == texts


def stored_tables(spark):
    folder = checkpoint_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if name.startswith("stored-")}


def test_what_is_stored_on_the_way_is_discarded(spark, documents):
    docs = documents(["one two three four five six"] * 2 + ["another text of some more words"])
    before = stored_tables(spark)
    outer = stored(docs)
    with discarding(spark):
        result = kept(neardup.without_near_duplicates(outer))
        assert len(stored_tables(spark) - before) > 2
        # Nothing was ever written there.
        new_folder(spark, "warc")
    assert len(stored_tables(spark) - before) == 2
    assert sorted(row["doc_id"] for row in result.collect()) == [0, 2] and outer.count() == 3
    with pytest.raises(ZeroDivisionError), discarding(spark):
        stored(docs)
        raise ZeroDivisionError
    assert len(stored_tables(spark) - before) == 2


def some_tagger():
    return bilstm.Tagger(pii.HIDDEN, 1 + 2 * len(pii.KINDS))


def test_a_result_name_that_is_taken(spark, documents):
    docs = documents(["some text", None])
    benchmark = spark.createDataFrame([(1, "some text")], "item_id int, text string")
    made = {
        "score": lambda d: quality.scored(d, quality.Model(0.0)),
        "licences": lambda d: license.scanned(d, license.train([])),
        "pii": lambda d: pii.find(d, some_tagger()),
        "hits": lambda d: decontaminate.contamination(d, benchmark),
        "dedup": substring.deduplicated,
    }
    for name, run in made.items():
        taken = run(docs.withColumnRenamed("key", name.upper()))
        assert taken.columns[-1] == f"_{name}" and taken.select(name).distinct().collect() == [("k",)]
        assert taken.count() == 2 and run(docs).columns == [*docs.columns, name]


def test_saved_models_score_as_before(spark, tmp_path):
    texts = [b"some text", b"", None, "caf\u00e9 at dot 1.2.3.4".encode()]
    random_ = np.random.default_rng(1)
    rows = random_.random((200, len(quality.FEATURES)))
    grown = quality.train(rows, (rows[:, 0] > rows[:, 1]).astype(float))
    owners, slots = np.repeat(np.arange(40), 2), np.tile([3, 4, 5, 6], 20)
    machine = toxicity.train(owners, slots, np.ones(80, np.float32), np.arange(40) % 2.0)
    licences, tagger = license.train([]), some_tagger()

    def again(model, name):
        save_model(spark, model, f"{tmp_path}/{name}")
        return load_model(spark, f"{tmp_path}/{name}")

    assert np.array_equal(again(grown, "quality").score(rows), grown.score(rows))
    assert np.array_equal(again(machine, "toxicity").score(texts), machine.score(texts))
    assert license.scan(again(licences, "licence"), texts) == license.scan(licences, texts)
    written = [(t or b"").decode() for t in texts]
    assert pii.all_spans(again(tagger, "pii"), written) == pii.all_spans(tagger, written)
