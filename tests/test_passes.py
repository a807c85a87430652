"""What a pass does only once: figures of texts, sums of clusters, walks of shared trees."""

import numpy as np
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.models import cluster as U
from scoutlens.models import forest as R
from scoutlens.plans import bindings as B


def test_forests_of_a_family_are_asked_in_one_walk():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, (400, 3)).astype(np.int8)
    y = (x[:, 0] + rng.integers(0, 9, 400) > 14).astype(float)
    forests = [R.Spec(i, num_trees=n, max_depth=d, min_split=m) for i, (n, d, m) in enumerate([(6, 9, 2), (3, 9, 2), (6, 3, 2), (5, 9, 60), (6, 2, 90)])]
    (shared, of), = R.families(forests, 3)
    for batch in R.batches_of(shared, 4):
        R.grow(batch, x, y, np.arange(400))
        mine = [f for f in of if f.num_trees > batch.first]
        for f, p in zip(mine, batch.predict_all(x, mine)):
            assert np.array_equal(p, batch.predict(x, f))


def test_a_trees_totals_are_those_of_its_rows():
    rng = np.random.default_rng(6)
    x, ids = rng.integers(0, 30, (300, 2)).astype(np.int8), np.arange(300)
    y = (rng.random(300) < x[:, 1] / 30).astype(float)
    batch = R.grow(R.Batch(R.Spec(0, num_trees=3, max_depth=6, min_leaf=4), 0, 3), x, y, ids)
    drawn = batch.weights(ids)
    node, at = np.tile(np.arange(3)[:, None], 300), [drawn > 0]
    for _ in range(batch.depth):
        for n in np.unique(node):
            assert batch.rows[n] == ((node == n) & at[0]).sum()
        inner = batch.feature[node] >= 0
        node = np.where(inner, batch.left[node] + (x[np.arange(300)[None], np.maximum(batch.feature[node], 0)] > batch.cut[node]), node)
    assert len(batch.feature) > 9


def test_pieces_of_work_are_dealt_evenly(spark):
    parts = R._work(spark, 100).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in parts) - min(r["count"] for r in parts) <= 1


def test_totals_of_all_models_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(-2, 3, (3000, 2)).astype(float)                  # many rows as near to several centres
    g = np.where(rng.random(3000) < 0.8, "a", "b")
    points = spark.createDataFrame([(str(k), v.tolist()) for k, v in zip(g, x)], "g string, x array<double>").repartition(3)
    centres = {k: {m: x[at].copy() for m, at in enumerate(([0, 1, 2], [3, 4], [5, 6, 7], [8, 8]))} for k in ("a", "b")}
    got = {(r["g"], r["model"], r["cluster"]): r for r in U._totals(points, centres, 2, True).collect()}
    assert len(got) == 2 * 10
    for k in ("a", "b"):
        for m, c in centres[k].items():
            far = ((x[g == k][:, None] - c[None]) ** 2).sum(axis=2)
            near = far.argmin(axis=1)
            for i in range(len(c)):
                r, mine = got[k, m, i], near == i
                assert r["n"] == mine.sum() and abs(r["cost"] - far[mine, i].sum()) < 1e-8
                assert np.allclose([r["s0"], r["s1"], r["q"]], [*x[g == k][mine].sum(axis=0), (x[g == k][mine] ** 2).sum()])
    assert "cost" not in U._totals(points, centres, 2).columns


def test_no_text_is_joined_with_its_labels(spark, sf_small):
    for how in ("inner", "left"):
        plan = B.supervised(spark, sf_small, how)._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join")
        assert "regexp_replace" not in plan[:join] and "regexp_replace" in plan[join:]


def test_figures_of_odd_texts(spark, tmp_path):
    texts = ["", None, "a1\nB22  É3", "   ", "\n\n", "ABC", "123", " x ", "é" * 70 + "7"]
    rows = [(i, t, "s", "en", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = B.supervised(spark, str(tmp_path), "left").orderBy("row_id", "y").collect()
    import re

    assert [r["row_id"] for r in got] == [0, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    for r in got:
        t = texts[r["row_id"]]
        if t is None:
            assert r["f_words"] is None and r["f_digits"] is None and r["f_upper"] is None
            continue
        assert r["f_digits"] == len(re.findall("[0-9]", t)) and r["f_upper"] == len(re.findall("[A-Z]", t))
        assert r["f_words"] == len(re.split(r"[ \t\n\x0b\f\r]+", t.strip(" ")))
        assert r["labelled"] == (r["row_id"] == 2)
    assert B.supervised(spark, str(tmp_path)).count() == 2 and C.SEARCH_DRAWS == 60
