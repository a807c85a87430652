"""Positive-unlabelled toxicity: held-out accuracy and edge rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from scoutlens.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    clean = [f"w{i}" for i in range(400)]
    bad = ["scoundrelly", "dolt", "nincompoop", "blatherskite"]
    docs, labels, found = [], [], set()
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(20, 60))
        if rng.random() < 0.17:
            words[3:3] = rng.choices(bad, k=4)
            found.add(i)
        docs.append((i, " ".join(words), f"other{i}", 1.0))
        if rng.random() < 0.5:
            labels.append((i, int(i in found)))
    # further columns under the operator's own names
    d = spark.createDataFrame(docs, "doc_id long, text string, key string, score double")
    return d, spark.createDataFrame(labels, "doc_id long, toxic int"), found


def test_held_out_texts_are_told_apart(corpus):
    docs, labels, toxic = corpus
    model = toxicity.fit(docs.where("doc_id % 3 <> 1"), labels.where("doc_id % 3 <> 1"))
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in rows if i % 3 == 1]
    caught = {i for i in held if rows[i] >= 0.7}
    assert len(rows) == 600 and caught == {i for i in held if i in toxic}
    left = toxicity.where_clean(docs, model)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {i for i in rows if rows[i] < 0.7}


def test_edge_rows_have_a_defined_score(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "dolt " * 5000), (3, None)], "doc_id long, text string")
    rows = toxicity.score(odd, model).collect()
    bias = float(model(np.array([model.bias]))[0])
    assert len(rows) == 5
    assert [r["score"] for r in rows if r["doc_id"] in (1, 3, None)] == pytest.approx([bias] * 4)
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_without_confirmed_texts_every_score_is_the_prior(spark, corpus):
    docs, labels, _ = corpus
    for known in (labels.where("toxic = 0"), labels.limit(0)):
        model = toxicity.fit(docs.limit(20), known)
        assert len(model.features) == 0
        assert {round(r["score"], 6) for r in toxicity.score(docs.limit(5), model).collect()} == {round(model.prior, 6)}


def test_support_counts_every_confirmed_text(corpus, monkeypatch):
    """max_positive bounds the training matrix only: the features kept do not depend on it."""
    docs, labels, _ = corpus
    positives, train = [], toxicity.train

    def seen(positive, *rest):
        positives.append(int(np.sum(positive)))
        return train(positive, *rest)

    monkeypatch.setattr(toxicity, "train", seen)
    whole = toxicity.fit(docs, labels)
    bounded = toxicity.fit(docs, labels, params=toxicity.Params(max_positive=10))
    assert len(whole.features) and whole.features.tolist() == bounded.features.tolist()
    assert positives == [labels.where("toxic = 1").count(), 10]


def test_negative_risk_is_not_followed_below_zero():
    """All unlabelled rows look like the positives: the corrected negative risk is negative and
    the step goes back, so the weight stays bounded."""
    have = pa.array([[0]] * 40, pa.list_(pa.int32()))
    positive = np.arange(40) < 20
    model = toxicity.train(positive, have, np.array([7]), 0.9, toxicity.Params(epochs=200))
    assert np.isfinite(model.weights).all() and abs(model.weights[0]) < 10
