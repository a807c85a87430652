"""Language identification: accuracy, expectation step by brute force, edge rows."""

import random

import numpy as np
import pytest

from scoutlens.llm import langid
from scoutlens.llm import lattice as L

WORDS = {"en": "the of and water house garden reading little morning with under".split(),
         "de": "der die und wasser haus garten lesen kleine morgen mit unter".split(),
         "fr": "le la et eau maison jardin lire petite matin avec sous".split()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=12)).capitalize(), lang, 0.5))
    rows += [(500, "unlabelled words of no language", None, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")


def test_held_out_languages(docs):
    model = langid.fit(docs.where("doc_id % 4 <> 2"))
    assert model.languages == ["de", "en", "fr"]
    rows = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert all(rows[i]["lang_pred"] == ("en", "de", "fr")[i % 3] for i in range(120) if i % 4 == 2)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_no_letter_is_undetermined(spark, docs):
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !! …"), (3, "12 !! …"), (4, "garden"), (5, "der " * 9000), (None, "the water")],
                                "doc_id long, text string")
    rows = langid.predict(odd, model).collect()
    assert len(rows) == 7
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (1, 2, 3))
    assert next(r for r in rows if r["doc_id"] is None)["lang_pred"] == "en"
    assert next(r for r in rows if r["doc_id"] == 5)["lang_pred"] == "de"
    kept = langid.where_known(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, None}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, docs):
    model = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs.limit(3), model).collect()} == {"und"}


def test_expected_counts_are_those_of_all_segmentations(spark):
    one = spark.createDataFrame([("on", "en")], "text string, lang string")
    model = langid.fit(one, smooth=0.0)
    vocab = L.vocabulary(langid.MODEL_PATH)
    own = {x: i for i, x in enumerate(vocab.pieces) if x and i not in set(vocab.byte_id.tolist())}

    def splits(atom):
        if not atom:
            yield ()
        for j in range(1, len(atom) + 1):
            if atom[:j] in own:
                for rest in splits(atom[j:]):
                    yield (own[atom[:j]], *rest)

    every = list(splits(b" on"))
    mass = [len(vocab.pieces) ** -float(len(s)) for s in every]
    counts = {}
    for s, m in zip(every, mass):
        for piece in s:
            counts[piece] = counts.get(piece, 0.0) + m / sum(mass)
    total = sum(counts.values())
    for piece, n in counts.items():
        assert model.probability[piece, 0] == pytest.approx(max(n / total, 1e-12), abs=1e-9)


def test_expected_counts_of_a_long_word(spark):
    """Pieces of a word that no place cuts: counts times bytes give the word back."""
    one = spark.createDataFrame([("x" * 200, "en")], "text string, lang string")
    model = langid.fit(one, smooth=0.0)
    vocab = L.vocabulary(langid.MODEL_PATH)
    used = [i for i in range(len(vocab.pieces)) if model.probability[i, 0] > 1e-11]
    assert {bytes(vocab.pieces[i]).strip(b" x") for i in used} == {b""} and len(used) > 3
    run = L.run(vocab, np.frombuffer(b" " + b"x" * 200, np.uint8))
    p = L.scaled(vocab, np.full((len(vocab.pieces), 1), 1.0 / len(vocab.pieces)))
    a, b = L.log_forward(run, p), L.log_backward(run, p)
    share = np.exp(a[run.start] + np.log(p[run.piece]) + b[run.start + run.length] - b[0])[:, 0]
    assert (share * run.length).sum() == pytest.approx(201, rel=1e-9)
    for i in used:
        assert model.probability[i, 0] == pytest.approx(share[run.piece == i].sum() / share.sum(), abs=1e-9)
