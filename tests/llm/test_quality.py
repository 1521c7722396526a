"""Quality classifier: accuracy on held-out documents and the parts of the model."""

import random
import zlib

import numpy as np

from aerolag.llm import quality
from tests.llm.conftest import prose


def sample(count=600):
    pick = random.Random(5)
    texts, labels = [], []
    for i in range(count):
        text = prose(pick, pick.randint(20, 120))
        bad = i % 4 == 0
        if bad:
            text = pick.choice([text.upper(), " ".join(w + "***" for w in text.split()), (text[:20] + " ") * 30])
        texts.append(text)
        labels.append(int(not bad))
    return texts, labels


def test_held_out_documents_are_told_apart(spark, documents):
    texts, labels = sample()
    rows = [(i, label, None) for i, label in enumerate(labels)] + [(3, None, 1), (None, 1, 1), (10**9, 0, 0)]
    known = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    docs = documents(texts + [None, ""])
    model = quality.fit(docs, known)
    scored = quality.scored(docs, model).select("doc_id", quality.held_out(docs["doc_id"]).alias("h"), "score").collect()
    right = []
    for row in scored:
        assert row["h"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1
        if row["h"] and row["doc_id"] < len(labels):
            right.append((row["score"] >= 0.5) == bool(labels[row["doc_id"]]))
    assert np.mean(right) > 0.95
    assert model == model and quality.scored(docs.where("false"), model).count() == 0


def test_training_is_bounded_and_repeats(spark, documents):
    texts, labels = sample(300)
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, quality int")
    models = [quality.fit(documents(texts).repartition(n), known, max_rows=150) for n in (1, 5)]
    rows = quality.features([t.encode() for t in texts])
    assert np.array_equal(models[0].score(rows), models[1].score(rows))


def test_one_class_or_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.fit(documents(["a"]), none).score(quality.features([b"a"])) == 0.5
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, quality int")
    assert quality.fit(documents(["a"] * 20), ones).score(quality.features([None]))[0] > 0.99


def test_pairs_learn_what_single_features_cannot():
    random_ = np.random.default_rng(3)
    rows = random_.random((3000, 4))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = quality.train(rows[:2000], labels[:2000])
    assert ((model.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.9
    single = quality.Model(model.intercept, model.edges, model.tables, model.pair_edges, [])
    assert ((single.score(rows[2000:]) > 0.5) == labels[2000:]).mean() < 0.7


def test_score_is_the_sum_of_table_entries():
    model = quality.Model(0.5, [np.array([1.0])], [np.array([-1.0, 2.0])], [np.array([1.0])], [(0, 0, np.eye(2))])
    scores = model.score(np.array([[0.5], [1.0], [3.0]]))
    assert np.allclose(scores, 1 / (1 + np.exp(-np.array([0.5, 0.5, 3.5]))))


def test_a_trained_model_scores_as_a_plain_walk_over_its_tables():
    random_ = np.random.default_rng(7)
    rows = random_.random((400, 5)).round(1)
    model = quality.train(rows, ((rows[:, 0] > 0.4) & (rows[:, 1] < 0.7)).astype(float))

    def plain(row):
        total = model.intercept
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(value > edge for edge in edges)]
        for a, b, table in model.pairs:
            total += table[sum(row[a] > e for e in model.pair_edges[a]), sum(row[b] > e for e in model.pair_edges[b])]
        return 1 / (1 + np.exp(-total))

    assert len(model.pairs) and np.allclose(model.score(rows), [plain(row) for row in rows])


def test_features_of_very_long_and_empty_texts():
    rows = quality.features([b"x" * 3_000_000, b"ab " * 500_000, b"", None])
    assert rows.shape == (4, len(quality.FEATURES)) and np.isfinite(rows).all()
    assert (rows[2] == rows[3]).all()
