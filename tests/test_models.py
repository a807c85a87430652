"""Invariants for trained-model operators (rows-only in the driver's check)."""

import pytest
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.models import cluster as U
from scoutlens.models import metrics
from scoutlens.models import supervised as S
from scoutlens.plans import bindings as B
from scoutlens.sources import files


@pytest.fixture(scope="module")
def d(spark, sf_small):
    return B.supervised(spark, sf_small).cache()


def test_lr_probabilities_and_percentiles(spark, d):
    model = S.train_lr(d, B.D_FEATURES, "y")
    out = S.score_all(model, d, B.D_FEATURES, part="position")
    stats = out.agg(F.min("talent_score"), F.max("talent_score"),
                    F.min("score_percentile"), F.max("score_percentile")).first()
    assert 0 <= stats[0] <= stats[1] <= 100
    assert 0 < stats[2] and stats[3] == 100.0
    imp = S.importances(model, B.D_FEATURES).agg(F.sum("importance")).first()[0]
    assert abs(imp - 1.0) < 1e-9


def test_rf_importances_and_roundtrip(spark, d):
    model = S.train_rf(d, B.D_FEATURES, "y", num_trees=10, max_depth=3)
    imp = S.importances(model, B.D_FEATURES).agg(F.sum("importance")).first()[0]
    assert abs(imp - 1.0) < 1e-9
    path = S.save_model(model, files.stage_path(spark, "rf"))
    back = S.load_model(path)
    a = S.positive_probability(model, d, B.D_FEATURES, "a").select("row_id", "a")
    b = S.positive_probability(back, d, B.D_FEATURES, "b").select("row_id", "b")
    assert a.join(b, "row_id").where(F.col("a") != F.col("b")).count() == 0


def test_grouped_folds_disjoint(spark, d):
    f = metrics.grouped_folds(d, "group", "y", 5)
    per_group = f.groupBy("group").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert per_group == 1
    assert {r.fold for r in f.select("fold").distinct().collect()} <= set(range(5))


def test_calibrated_in_unit_interval(spark, d):
    out = S.calibrated_scores(d, B.D_FEATURES, "y", k=3)
    r = out.agg(F.min("p_calibrated"), F.max("p_calibrated"), F.count("*")).first()
    assert 0 <= r[0] <= r[1] <= 1 and r[2] == d.count()


def test_oot_split_disjoint(spark):
    df = spark.createDataFrame([("LFL", 2024), ("LFL", 2025), ("LEC", 2024), ("PRM", 2026)],
                               "league string, _source_year int")
    parts = {(r.league, r._source_year): r.part for r in S.oot_split(df).collect()}
    assert parts == {("LFL", 2024): "train", ("LFL", 2025): "test", ("PRM", 2026): None}


def test_clusters_and_pca(spark, sf_small):
    v = B.vectors(spark, sf_small).cache()
    sweep = U.k_sweep(v, C.CLUSTER_FEATURES, "position", ks=[2, 3], n_init=1, min_rows=5)
    assert sweep.groupBy("position").agg(F.count_if("is_best").alias("b")).agg(F.min("b")).first()[0] == 1
    best = {r.position: 2 for r in v.select("position").distinct().collect()}
    cl = U.cluster_by_position(v, C.CLUSTER_FEATURES, best, n_init=1, min_rows=5)
    assert cl.count() == v.count()
    assert {r.cluster for r in cl.select("cluster").distinct().collect()} <= {-1, 0, 1}
    emb = U.embed_2d(v, C.CLUSTER_FEATURES)
    assert emb.where(F.col("umap_x").isNull()).count() == 0


def test_similarity_top_k_and_unknown(spark, sf_small):
    v = B.vectors(spark, sf_small)
    top = U.similar(v, "playername", "V3", C.CLUSTER_FEATURES, 5).collect()
    assert len(top) <= 5 and all(r.playername.lower() != "v3" for r in top)
    d = [r.similarity_distance for r in top]
    assert d == sorted(d)
    assert U.similar(v, "playername", "nobody", C.CLUSTER_FEATURES, 5).count() == 0


def test_embedding_equals_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(int(i % 3), *map(float, v)) for i, v in enumerate(rng.normal(0, [3, 1, 2, 0.5], (300, 4)) @ rng.normal(0, 1, (4, 4)))]
    rows += [(None, *map(float, v)) for v in rng.normal(0, 1, (40, 4))] + [(9, 1.0, 2.0, 3.0, 4.0), (8, 1.0, 1.0, 1.0, 1.0), (8, 1.0, 1.0, 1.0, 1.0)]
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, position int, a double, b double, c double, d double")
    got = {r["row_id"]: (r["umap_x"], r["umap_y"]) for r in U.embed_2d(df.repartition(3), cols).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == (None, None) for i, r in enumerate(rows) if r[0] is None)
    for g in {r[0] for r in rows} - {None}:
        ids = [i for i, r in enumerate(rows) if r[0] == g]
        x = np.array([rows[i][1:] for i in ids])
        dev = x.std(axis=0)
        z = (x - x.mean(axis=0)) / np.where(dev > 0, dev, 1.0)
        axes = np.linalg.svd(z, full_matrices=True)[2][:2] if len(ids) > 2 else np.zeros((2, 4))
        axes = axes * np.sign(axes[np.arange(2), abs(axes).argmax(axis=1)])[:, None]
        assert np.array([got[i] for i in ids]) == pytest.approx(z @ axes.T, abs=1e-9)


def numpy_newton(x, y, w, ridge):
    import numpy as np

    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    r = np.full(z.shape[1], ridge)
    r[0] = 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ beta))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(r), z.T @ (w * (p - y)) + r * beta)
        beta = beta - step
    return beta


def test_newton_equals_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(0, [1, 5, 0.1], (500, 3)) + [3, 0, 7]
    y = (x[:, 0] + 0.2 * x[:, 1] + rng.normal(0, 1, 500) > 3.6).astype(int)
    fold = np.arange(500) % 4
    rows = [(int(i), int(f), int(t), *map(float, v)) for i, (f, t, v) in enumerate(zip(fold, y, x))]
    df = spark.createDataFrame(rows, "row_id long, f int, y int, a double, b double, c double").repartition(5)
    cols = ["a", "b", "c"]

    def expected(use):
        mean, dev, n = x[use].mean(axis=0), x[use].std(axis=0), use.sum()
        w = np.where(y[use] == 1, n / (2 * y[use].sum()), n / (2 * (1 - y[use]).sum()))
        return mean, dev, numpy_newton((x[use] - mean) / dev, y[use], w, 1 / C.LR_C)

    model = S.train_lr(df, cols, "y")
    assert model.beta == pytest.approx(expected(np.ones(500, bool))[2], abs=1e-8)
    fitted = S.fit_calibrated(df, cols, "y", k=4, fold_col="f")
    assert len(fitted) == 4
    p = np.zeros(500)
    for k, (m, a, b) in enumerate(fitted):
        mean, dev, beta = expected(fold != k)
        assert m.beta == pytest.approx(beta, abs=1e-8)
        margin = beta[0] + (x - mean) / dev @ beta[1:]
        held = fold == k
        pos = y[held].sum()
        t = np.where(y[held] == 1, (pos + 1) / (pos + 2), 1 / (held.sum() - pos + 2))
        platt = numpy_newton(margin[held][:, None], t, np.ones(held.sum()), 0.0)
        assert (b, a) == (pytest.approx(platt[0], abs=1e-7), pytest.approx(platt[1], abs=1e-7))
        p += 1 / (1 + np.exp(-(a * margin + b))) / 4
    got = {r["row_id"]: r["p_calibrated"] for r in S.apply_calibrated(fitted, df, cols).collect()}
    assert [got[i] for i in range(500)] == pytest.approx(p, abs=1e-9)
    back = S.load_model(S.save_model(model, files.stage_path(spark, "logistic")))
    assert (back.beta == model.beta).all() and back.cols == cols


def test_newton_edges(spark):
    flat = spark.createDataFrame([(i, i % 2, 1.0, None) for i in range(10)], "row_id long, y int, a double, b double")
    model = S.train_lr(flat, ["a", "b"], "y")
    assert model.beta == pytest.approx([0, 0, 0], abs=1e-9)
    with pytest.raises(ValueError):
        S.train_lr(flat.where("y = 0"), ["a"], "y")
    apart = spark.createDataFrame([(i, int(i > 20), float(i)) for i in range(41)], "row_id long, y int, a double")
    out = S.calibrated_scores(apart, ["a"], "y", k=5).agg(F.min("p_calibrated"), F.max("p_calibrated")).first()
    assert 0 <= out[0] < 0.3 and 0.7 < out[1] <= 1


def test_starts_are_different_vectors(spark):
    """A group of which nine tenths are copies of one vector still gives k different starts."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [("hot", [1.0, 1.0])] * 18000 + [("hot", [float(v) for v in x]) for x in rng.normal(0, 3, (2000, 2))]
    rows += [("few", [float(i), 0.0]) for i in range(5)] * 10 + [("one", [2.0, 2.0])] * 3000
    points = spark.createDataFrame(rows, "g string, x array<double>").repartition(4)
    drawn = U.start_sample(points, ["hot", "few", "one"]).collect()
    by = {g: [r for r in drawn if r["g"] == g] for g in ("hot", "few", "one")}
    assert len(by["few"]) == 5 and all(r["w"] == 10 for r in by["few"]) and len(by["one"]) == 1
    assert 500 < len(by["hot"]) < 2500 and max(r["w"] for r in by["hot"]) == 18000
    assert 15000 < sum(r["w"] for r in by["hot"]) < 25000
    for seed in range(10):
        x, w = np.array([r["x"] for r in by["hot"]]), np.array([r["w"] for r in by["hot"]])
        assert len({tuple(c) for c in U._plus_plus(x, 9, np.random.default_rng(seed), w)}) == 9
    found = U.kmeans_many(points, {"hot": [4], "few": [5], "one": [1]}, 2, 3)
    assert len({tuple(c) for c in found["hot", 4][0]}) == 4 and found["few", 5][1] == pytest.approx(0) and found["one", 1][1] == 0
