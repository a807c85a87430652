"""Deleted interpolation against plain Python counts."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from scoutlens.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return ["<s>", *WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 7


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(9000)]
    out = [(i, " ".join(words[rng.randrange(8000):][:rng.randint(0, 80)])) for i in range(260)]
    return out + [(300, None), (301, ""), (302, "The the THE é\tÉ"), (303, "w1 " * 6000), (302, "The the THE é\tÉ"), (None, "w1 w2")]


def test_scores_are_those_of_plain_counts(spark, texts, monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 1 << 12)             # many batches and hash ranges
    monkeypatch.setattr(lm, "RANGE", 1 << 12)
    seen = {}
    plain = lm.weights
    monkeypatch.setattr(lm, "weights", lambda grid: seen.setdefault("w", plain(grid)))
    docs = spark.createDataFrame([(k, x, 0, "b") for k, x in texts], "doc_id long, text string, fold int, batch string")
    rows = lm.score(docs).collect()
    assert len(rows) == len(texts)
    learning = [tokens(x) for k, x in texts if fold(k) != 2]
    one, two = collections.Counter(), collections.Counter()
    for t in learning:
        one.update(t[1:])
        two.update(zip(t, t[1:]))
    n, v, w = sum(one.values()), len(one), seen["w"]
    want = collections.defaultdict(list)
    for k, x in texts:
        t = tokens(x)
        base = sum(math.log10((one[a] + 1) / (n + v + 1)) for a in t[1:])
        score = 0.0
        for b, a in zip(t, t[1:]):
            c = len(learning) if b == "<s>" else one[b]
            m = w[min(lm.BUCKETS - 1, 1 + int(math.log2(c))) if c else 0]
            score += math.log10(m[0] * two[b, a] / max(c, 1) + m[1] * one[a] / n + m[2] / (v + 1))
        want[k].append((len(t) - 1, sum(one[a] > 0 for a in t[1:]), n, fold(k) == 2, base, score))
    for r in rows:
        e = want[r["doc_id"]][0]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == e[:4]
        assert r["base_score"] == pytest.approx(e[4], rel=1e-9) and r["score"] == pytest.approx(e[5], rel=1e-7)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_weights_are_a_fixed_point_of_the_likelihood():
    """Against a grid search over the simplex, for one bucket."""
    rng = np.random.default_rng(3)
    x2, x1, n = rng.normal(2, 3, 60), rng.normal(1, 2, 60), rng.integers(1, 9, 60) * 1000
    x2[:20] = np.nan
    grid = pa.table({"bucket": pa.array([4] * 60), "n": pa.array(n), "x2": pa.array(x2, from_pandas=True), "x1": pa.array(x1)})
    w = lm.weights(grid, 500)[4]
    ratio = np.stack([np.where(np.isnan(x2), 0, np.exp2(np.nan_to_num(x2))), np.exp2(x1), np.ones(60)], axis=1)
    like = lambda w: float((n * np.log(ratio @ w)).sum())
    best = max(like(np.array([a, b, 1 - a - b])) for a in np.arange(0.005, 1, 0.01) for b in np.arange(0.005, 1 - a, 0.01))
    assert like(w) >= best - 1e-4 * abs(best) and w.sum() == pytest.approx(1.0)
    assert lm.weights(grid)[0][0] == 0.0                  # an unseen context has no bigram part


def test_empty_and_unlearned_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm.score(docs.limit(0)).count() == 0
    held = next(i for i in range(100) if fold(i) == 2)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_tokens"], row["n_known"], row["held_out"]) == (0, 3, 0, True)
    assert row["base_score"] == pytest.approx(0.0)
