"""Steps that must not be repeated, or grow faster than their input."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.models import cluster, density
from scoutlens.models import forest as R
from scoutlens.operators import features
from scoutlens.plans import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents (one twice, one without key or text) and labels of two in three of them."""
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, "Some Words 12 " * (1 + i % 5) + "AB" * (i % 3), "de" if i % 4 else "en", f"s{i % 6}") for i in range(60)]
    rows += [rows[7], (None, None, "de", None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars int") \
        .write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(60) if i % 3], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{at}/labels.parquet")
    return at


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["lr_scores", "rf_scores", "score_all_players", "calibrated_scores"])
def test_texts_are_read_once(spark, tables, name):
    """Features and scores are stage tables: neither ranking nor scoring goes back to the texts."""
    df = QUERIES[name](spark, tables)
    assert "regexp_replace" not in plan_of(df)
    assert df.count() == 62


def test_forests_of_a_family_share_their_trees():
    """Trees grown once and cut back are those that each forest grows by itself; few trees are grown for a whole search."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 30, (500, 5))
    y, ids = (x[:, 0] + rng.normal(0, 8, 500) > 20).astype(float), np.arange(500)
    specs = [R.Spec(i, t, d, split, 2, feats, fold=1) for i, (t, d, split, feats) in enumerate(
        [(3, 4, 2, "sqrt"), (7, 30, 20, "0.5"), (5, 8, 5, "log2"), (4, 6, 2, "0.7")])]
    (shared, forests), (alone, one) = R.families(specs, 5)
    assert [s.forest for s in forests] == [0, 1, 2] and [s.forest for s in one] == [3]
    assert (shared.num_trees, shared.max_depth, shared.min_split) == (7, 30, 2)
    for of in (*forests, *one):
        own = sum(R.grow(b, x, y, ids).predict(x) for b in R.batches_of(of, 2))
        cut = sum(R.grow(b, x, y, ids).predict(x, of) for b in R.batches_of(shared if of in forests else alone, 4) if b.first < of.num_trees)
        assert cut == pytest.approx(own)
    every = [R.Spec(i, fold=f, **p) for i, p in enumerate(R.draws(C.RF_GRID, 60)) for f in range(5)]
    assert sum(s.num_trees for s, _ in R.families(every, 5)) < 0.55 * sum(s.num_trees for s in every)


def test_passes_over_partitions_are_bounded(spark, monkeypatch):
    """Histograms travel in blocks and a pass counts few of them; the forest is the one grown at hand."""
    monkeypatch.setattr(R, "BLOCK", 4)
    monkeypatch.setattr(R, "PASS_NODES", 8)
    asked, splits = [], R._splits
    monkeypatch.setattr(R, "_splits", lambda rows, wave, weight, blocks: asked.append(len(blocks)) or splits(rows, wave, weight, blocks))
    rng = np.random.default_rng(6)
    rows = [(*map(float, rng.integers(0, 9, 2)), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y int").repartition(2)
    spec = R.Spec(0, 6, 3, class_weight="balanced_subsample")
    far, near = (R.fit(df, ["a", "b"], "y", spec, local_rows=n) for n in (0, 1000))
    assert max(asked) == 2 and len(asked) > 3
    got = [f.transform(df).select("a", "b", F.round(vector_to_array("probability")[1], 9).alias("p")).distinct().orderBy("a", "b").collect()
           for f in (far, near)]
    assert len(got[0]) == len(got[1]) == len({(r["a"], r["b"]) for r in got[0]})
    assert all(b.path is None and b.feature.dtype == np.int16 for f in (far, near) for b in f.batches)


def test_features_shuffle_pairs_of_key_and_champion_apart(spark):
    """Only the distinct (key, champion) pairs are grouped by champion, and equal champions, nulls and keys count as before."""
    rows = [("p", "L", 2024, "top", g, r, c, float(g)) for g, r, c in
            ((1, 1, "a"), (2, 0, "a"), (3, 1, "b"), (4, 1, None))] + [("q", "L", 2024, "top", 5, 0, None, 2.0), (None, "L", 2024, "top", 6, 0, "a", 2.0)]
    df = spark.createDataFrame(rows, "playername string, league string, _source_year int, position string, gameid long, result int, champion string, kills double")
    out = features.aggregate_players(df, ["playername", "league", "_source_year", "position"], ["kills"])
    assert {r["playername"]: (r["games_played"], r["champion_pool_size"], r["kills"]) for r in out.collect()} == {"p": (4, 2, 2.5), "q": (1, 0, 2.0)}
    assert out.columns[4:7] == ["games_played", "win_rate", "champion_pool_size"]
    grouped = [line for line in plan_of(out).split("== Physical Plan ==")[1].splitlines() if "HashAggregate" in line and "champion" in line.split("functions=")[0]]
    assert grouped and all("functions=[]" in line for line in grouped)


def test_sweep_points_are_spread_and_scored_in_tasks(spark):
    """Points of one file are dealt over the cluster; the models' silhouettes are those of the general operator."""
    rng = np.random.default_rng(7)
    rows = [("a" if i % 3 else None if i % 2 else "b", *map(float, rng.normal(0, 1, 3) + 3 * (i % 4))) for i in range(240)]
    rows += [("same", 1.0, 1.0, 1.0)] * 30
    df = spark.createDataFrame(rows, "position string, x double, y double, z double").coalesce(1)
    points = cluster._points(df, ["x", "y", "z"], "position")
    assert len({r[0] for r in points.select(F.input_file_name()).collect()}) > 1
    best = cluster.kmeans_many(points, {"a": [2, 4], "b": [3], "same": [2]}, 3, 2)
    got = {(r["g"], r["k"]): r["silhouette"] for r in cluster._model_silhouettes(points, best, 3).collect()}
    x = {g: np.array([r["x"] for r in points.where(F.col("g") == g).collect()]) for g in ("a", "b")}
    for (g, k), (centres, _) in best.items():
        if g == "same":                                      # one spot: one cluster, no silhouette
            assert (g, k) not in got
            continue
        label = next(cluster._assign(x[g], [centres]))[0]
        far = ((x[g][:, None] - x[g][None]) ** 2).sum(axis=2)
        total = np.stack([far[:, label == c].sum(axis=1) for c in range(k)], axis=1)
        n = np.bincount(label, minlength=k)
        a = total[np.arange(len(label)), label] / np.maximum(n[label] - 1, 1)
        b = np.where(np.arange(k) == label[:, None], np.inf, total / n).min(axis=1)
        assert got[g, k] == pytest.approx(np.where(n[label] <= 1, 0, (b - a) / np.maximum(a, b)).mean())


def test_small_clusters_send_one_number_per_row_and_tile(spark, monkeypatch):
    """Very many clusters: what leaves the tiles grows with rows and tiles, not with clusters; the silhouette is exact."""
    rng = np.random.default_rng(8)
    x, label = rng.normal(0, 1, (240, 2)), rng.integers(0, 60, 240)
    df = spark.createDataFrame([(int(c), *map(float, v)) for c, v in zip(label, x)], "c int, a double, b double")
    sent, plain = [], density.join_small
    monkeypatch.setattr(density, "join_small", lambda big, small, on, how="left": ("far" in big.columns and sent.append(big.count())) or plain(big, small, on, how))
    got = density.silhouette_exact(df, "c", ["a", "b"], tile=64).first()["silhouette"]
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    names = np.unique(label)
    total = np.stack([far[:, label == c].sum(axis=1) for c in names], axis=1)
    n, own = np.array([(label == c).sum() for c in names]), np.searchsorted(names, label)
    a = total[np.arange(240), own] / np.maximum(n[own] - 1, 1)
    b = np.where(np.arange(len(names)) == own[:, None], np.inf, total / n).min(axis=1)
    assert got == pytest.approx(np.where(n[own] <= 1, 0, (b - a) / np.maximum(a, b)).mean())
    assert sent[0] <= 240 * 5                                # own cluster and the least of others; 240 * 60 pairs before
