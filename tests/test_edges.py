"""Inputs the test tables lack: empty tables, coinciding points, missing features, odd files."""

import pytest
from pyspark.sql import functions as F

from scoutlens.models import cluster as U
from scoutlens.models import metrics
from scoutlens.operators import order_stats, quality, serve
from scoutlens.sources import files


def test_files_of_a_year_may_order_columns_differently(spark, tmp_path):
    (tmp_path / "2024_a.csv").write_text("gameid,kills,league\ng1,3,LFL\n")
    (tmp_path / "2024_b.csv").write_text("league,gameid,kills\nPRM,g2,5\n")
    rows = files.load_yearly(spark, str(tmp_path), [2023, 2024], required=["gameid", "league"], numeric=["kills"])
    assert sorted((r.gameid, r.kills, r.league) for r in rows.collect()) == [("g1", "3", "LFL"), ("g2", "5", "PRM")]


def test_text_in_a_number_column_is_refused_at_load(spark, tmp_path):
    (tmp_path / "2024_a.csv").write_text("gameid,kills,deaths\ng1,three,x\ng2,4,\n")
    with pytest.raises(files.SchemaValidationError, match=r"deaths \(1\), kills \(1\)"):
        files.load_yearly(spark, str(tmp_path), [2024], numeric=["kills", "deaths", "absent"])


def test_validation_of_an_empty_table(spark):
    df = spark.createDataFrame([], "playername string, teamname string, league string, position string, promoted_to_lec boolean")
    rows = {r["check"]: r for r in quality.validate(df).collect()}
    assert rows["non_empty"]["ok"] is False and rows["all_ok"]["ok"] is False
    assert rows["target_rate_pct"]["value"] is None


def test_silhouette_of_coinciding_points_is_zero(spark):
    df = spark.createDataFrame([(i % 2, 1.0, 2.0) for i in range(6)], "c int, a double, b double")
    assert U.silhouette(df, "c", ["a", "b"]).first()["silhouette"] == 0.0


def test_missing_features_count_zero_before_scaling(spark):
    df = spark.createDataFrame([(1, "a", 4.0), (2, "b", None), (3, "c", float("nan")), (4, "d", 8.0)],
                               "row_id int, playername string, f double")
    near = U.similar(df, "playername", "B", ["f"], 3).collect()
    assert [r.row_id for r in near] == [3, 1, 4] and near[0].similarity_distance == 0.0
    points = {round(r["x"][0], 6) for r in U._points(df.withColumn("p", F.lit("x")), ["f"], "p").collect()}
    mean, dev = 3.0, 11.0 ** 0.5
    assert points == {round((v - mean) / dev, 6) for v in (0.0, 4.0, 8.0)}


def test_nan_is_missing_in_order_statistics(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    assert order_stats.exact_quantiles(df, [], "v", [0.5]).first()["q"] == 2.0


def test_global_sweep_has_a_best_k(spark):
    df = spark.createDataFrame([(float(i % 3) * 9 + 0.01 * i, float(i % 3)) for i in range(60)], "a double, b double")
    sweep = U.k_sweep(df, ["a", "b"], None, ks=[2, 3, 4], n_init=3)
    assert sweep.columns == ["k", "inertia", "silhouette", "best_k", "is_best"]
    rows = {r.k: r for r in sweep.collect()}
    assert rows[3].is_best and not rows[2].is_best and rows[4].best_k == 3
    grouped = U.k_sweep(df.withColumn("role", F.lit("x")), ["a", "b"], "role", ks=[2, 3], n_init=2)
    assert grouped.columns[0] == "role" and grouped.where("is_best").first()["k"] == 3


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_GROUPS", 3)
    df = spark.range(20).select(F.col("id").cast("string").alias("g"))
    with pytest.raises(ValueError, match="groups"):
        U._groups(df, "g", 3)


def test_null_group_has_a_fold(spark):
    df = spark.createDataFrame([(None, 1), ("a", 0), ("b", 1), (None, 0), ("c", 0)], "g string, y int")
    rows = metrics.grouped_folds(df, "g", "y", 2).collect()
    assert len(rows) == 5 and all(r.fold is not None for r in rows)
    assert len({r.fold for r in rows if r.g is None}) == 1


def test_shortlist_keeps_rows_without_a_positive_score(spark):
    scores = spark.createDataFrame([(1, "top", -2.0), (2, "mid", None)], "playername int, position string, talent_score double")
    labels = spark.createDataFrame([(1, "top", 0, "x")], "playername int, position string, cluster int, archetype string")
    lookup = spark.createDataFrame([("top", 0, "x")], "position string, cluster int, archetype string")
    assert serve.shortlist(scores, labels, lookup, ["playername", "position"]).count() == 2
    assert serve.shortlist(scores, labels, lookup, ["playername", "position"], min_score=0.0).count() == 0
