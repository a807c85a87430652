"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from scoutlens.llm import ann


def brute(rows, queries, k):
    d = max({len(v) for _, v in rows}, key=lambda n: sum(len(v) == n for _, v in rows))
    rows = sorted({(i, tuple(v)) for i, v in rows if len(v) == d})
    out = {}
    for q, v in sorted(set((i, tuple(v)) for i, v in queries)):
        scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)[:k]
        out[q] = [(i, -s) for s, i in scored]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 24))
    x *= rng.uniform(0.2, 3.0, (3000, 1))                 # lengths differ: inner product is not cosine
    x[:1000] = x[0]                                       # a hot vector
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1.0, [i]) for i, v in enumerate(x)],
                               "vec_id long, embedding array<float>, score double, ids array<int>")
    return df, [(i, v.astype(float).tolist()) for i, v in enumerate(x)]


def test_recall_and_exact_scores(clustered):
    df, rows = clustered
    got = found(ann.search(df, df.where("vec_id % 20 = 0"), 20, params=ann.Params(sample=512, seeds=64)))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    vec = dict(rows)
    for q, v in got.items():
        assert q not in {i for i, _ in v}
        assert all(s == pytest.approx(float(np.dot(vec[q], vec[i])), rel=1e-12) for i, s in v)
        assert v == sorted(v, key=lambda x: (-x[1], x[0]))


def test_small_tables_give_all_candidates_in_order(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 2.0]), (3, [0.0, 1.0]), (20, [2.0, 2.0]),
            (40, [2.0, 2.0]), (60, [5.0, 5.0, 5.0])]
    odd = [(80, None), (100, []), (120, [0.0, 0.0]), (140, [1.0, None]), (160, [float("nan"), 1.0]),
           (180, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = found(ann.search(df, df.where("vec_id % 20 = 0 or vec_id = 3"), 20))
    assert got == brute(rows, [r for r in rows if r[0] in (3, 20, 40)], 20)
    assert got[20][0] == (40, 8.0) and {i for i, _ in got[20]} == {1, 2, 3, 4, 40}
    assert ann.search(df.limit(0), df, 20).count() == 0 and ann.search(df, df.limit(0), 20).count() == 0


def test_scan_abandons_most_and_keeps_what_reaches_the_floor():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 64))
    x, q = (centres[rng.integers(0, 8, n)] + 0.5 * rng.normal(size=(n, 64)) for n in (2000, 20))
    score = q @ x.T
    floor = np.sort(score, axis=1)[:, -10]
    rotation = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    i, j = ann.scan(x, q, floor, rotation)
    reached = {(a, b) for a, b in zip(*np.nonzero(score >= floor[:, None]))}
    assert len(reached & set(zip(i, j))) >= 0.95 * len(reached)
    assert len(i) < 0.5 * score.size
    assert len(ann.scan(x, q, np.full(20, -np.inf), rotation)[0]) == score.size


def test_queries_of_the_rows_dimension_are_kept(spark):
    """The rows' commonest dimension counts, also where most queries have another one."""
    rows = [(i, [float(i), 1.0]) for i in range(1, 40)] + [(20 * i, [1.0, 2.0, float(i)]) for i in (5, 6, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.search(df, df.where("vec_id % 20 = 0"), 20))
    assert set(got) == {20} and got == brute(rows[:39], [rows[19]], 20)


def test_recall_of_the_registered_setting(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(150, 32))
    x = (centres[rng.integers(0, 150, 20000)] + 0.6 * rng.normal(size=(20000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(ann.search(df, df.where("vec_id % 40 = 0")))
    score = x[::40].astype(float) @ x.astype(float).T
    score[np.arange(500), np.arange(0, 20000, 40)] = -np.inf
    want = np.argpartition(-score, 19, axis=1)[:, :20]
    assert sum(len({i for i, _ in got[40 * q]} & set(w.tolist())) for q, w in enumerate(want)) / (20 * 500) >= 0.93
