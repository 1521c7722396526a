"""Toxicity: accuracy on held-out documents, pairs of terms, gradients of the machine, edge tables."""

import random
import zlib

import numpy as np
import pytest

from aerolag.llm import toxicity
from tests.llm.conftest import prose


def sample(count, toxic_terms, seed=5, share=8):
    pick = random.Random(seed)
    texts, labels = [], []
    for i in range(count):
        words = prose(pick, pick.randint(10, 90)).split()
        label = int(i % share == 0)
        if label:
            for term in pick.sample(toxic_terms, 2):
                words.insert(pick.randint(0, len(words)), term)
        texts.append(" ".join(words))
        labels.append(label)
    return texts, labels


INSULTS = ["vileword", "grimword", "foulword", "meanword"]


def test_held_out_documents_are_told_apart(spark, documents):
    texts, labels = sample(900, INSULTS)
    rows = [(i, label, None) for i, label in enumerate(labels)] + [(3, None, 1), (None, 1, 1), (10**9, 0, 0)]
    known = spark.createDataFrame(rows, "doc_id bigint, toxic int, quality int")
    docs = documents(texts + [None, "", "word " * 30_000, "x" * 200_000])
    model = toxicity.fit(docs, known)
    scored = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert len(scored) == len(texts) + 4 and all(0 <= s <= 1 for s in scored.values())
    assert scored[len(texts)] == scored[len(texts) + 1]
    held = [i for i in range(len(labels)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scored[i] >= 0.5) == bool(labels[i]) for i in held]) > 0.95
    assert np.mean([scored[i] >= 0.5 for i in held if labels[i]]) > 0.9
    assert toxicity.scored(docs.where("false"), model).count() == 0
    taken = toxicity.scored(docs.withColumnRenamed("lang", "Score"), model)
    assert taken.columns == ["doc_id", "text", "Score", *docs.columns[3:], "_score"]


def test_training_is_bounded_and_repeats(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    texts, labels = sample(300, INSULTS)
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    models = [toxicity.fit(documents(texts).repartition(n), known, max_rows=150) for n in (1, 5)]
    encoded = [t.encode() for t in texts]
    assert np.array_equal(models[0].score(encoded), models[1].score(encoded))


def test_one_class_or_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.fit(documents(["a"]), none).score([b"a", None]).tolist() == [0.5, 0.5]
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id bigint, toxic int")
    assert toxicity.fit(documents(["a"] * 20), ones).score([None])[0] > 0.99


def pair_sample(count, seed):
    """Toxic only where an insult meets a group; each alone is harmless."""
    pick = random.Random(seed)
    texts, labels = [], []
    for i in range(count):
        words = prose(pick, 12, [f"w{j}" for j in range(60)]).split()
        words += [w for w, on in zip(("slurword", "folkword"), ((i >> 1) & 1, i & 1)) if on]
        pick.shuffle(words)
        texts.append(" ".join(words).encode())
        labels.append(float(i % 4 == 3))
    return texts, np.array(labels)


def test_pairs_learn_what_weights_cannot():
    texts, labels = pair_sample(1600, 2)
    model = toxicity.train(*toxicity.terms(texts), labels)
    test, truth = pair_sample(400, 3)
    assert ((model.score(test) >= 0.5) == truth).mean() > 0.97
    model.factors = np.zeros_like(model.factors)
    assert ((model.score(test) >= 0.5) == truth).mean() < 0.9


def test_margin_is_the_sum_over_all_pairs():
    texts, labels = pair_sample(200, 4)
    model = toxicity.train(*toxicity.terms(texts), labels)
    owners, slots, values = toxicity.terms(texts)
    for i in range(5):
        own = (owners == i) & (model.row_of[slots] >= 0)
        rows, x = model.row_of[slots[own]], values[own].astype(float)
        x /= max(1.0, (x**2).sum()) ** 0.25
        total = model.bias + (model.weights[rows] * x).sum()
        for a in range(len(rows)):
            for b in range(a):
                total += model.factors[rows[a]].astype(float) @ model.factors[rows[b]] * x[a] * x[b]
        assert model.score([texts[i]])[0] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-4)
