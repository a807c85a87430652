"""Semantics traps — each pinned by a hand-made case."""

import datetime as dt
import math

from pyspark.sql import functions as F

from scoutlens import functions as X
from scoutlens.models import cluster as U
from scoutlens.models import metrics
from scoutlens.operators import clean, features, rank, serve


def test_ansi_safe_parse_and_number(spark):
    df = spark.createDataFrame([("2024-03-01 10:00:00", "1.5"), ("not a date", "abc"),
                                ("2024-03-02", "NaN")], "d string, x string")
    out = df.select(X.parse_ts("d").alias("t"), X.to_number("x").alias("n")).collect()
    assert out[0].t == dt.datetime(2024, 3, 1, 10, 0) and out[0].n == 1.5
    assert out[1].t is None and out[1].n is None
    assert out[2].t == dt.datetime(2024, 3, 2) and out[2].n is None   # NaN -> NULL


def test_zscore_sample_std_and_singleton(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("a", None)], "g string, x double")
    out = {(r.g, r.x): r.x_zscore for r in
           features.add_zscores(df, ["x"], ["g"]).collect()}
    s = math.sqrt(2.0)  # sample std of (1, 3)
    assert abs(out[("a", 1.0)] + 1 / s) < 1e-12 and abs(out[("a", 3.0)] - 1 / s) < 1e-12
    assert out[("b", 5.0)] == 0.0          # singleton: std undefined -> 0
    assert out[("a", None)] == 0.0         # NULL value -> 0


def test_null_keys_dropped_and_count_non_null(spark):
    df = spark.createDataFrame(
        [("p", "L", 1, 1, "c1"), ("p", "L", None, 0, "c1"), (None, "L", 2, 1, "c2")],
        "playername string, league string, gameid int, result int, champion string")
    out = features.aggregate_players(df, ["playername", "league"]).collect()
    assert len(out) == 1
    assert out[0].games_played == 1 and out[0].win_rate == 0.5 and out[0].champion_pool_size == 1


def test_team_total_all_missing_is_zero(spark):
    df = spark.createDataFrame([(1, "t", None, 1.0), (1, "t", None, 2.0)],
                               "gameid int, teamname string, kills double, assists double")
    out = features.kill_participation(df).collect()
    assert all(r.killparticipation == 0.0 for r in out)


def test_participation_clip_and_zero_team(spark):
    df = spark.createDataFrame([(1, "t", 3.0, 5.0), (1, "t", 1.0, 0.0), (2, "u", 0.0, 2.0)],
                               "gameid int, teamname string, kills double, assists double")
    out = {(r.gameid, r.kills): r.killparticipation for r in features.kill_participation(df).collect()}
    assert out[(1, 3.0)] == 1.0          # (3+5)/4 clipped to 1
    assert out[(1, 1.0)] == 0.25
    assert out[(2, 0.0)] == 0.0          # team kills 0 -> 0


def test_percentile_ties_average_rank(spark):
    df = spark.createDataFrame([("mid", 1.0), ("mid", 2.0), ("mid", 2.0), ("mid", 3.0)],
                               "position string, talent_score double")
    out = sorted(r.score_percentile for r in
                 rank.percentile_rank_avg(df, ["position"], "talent_score").collect())
    assert out == [25.0, 62.5, 62.5, 100.0]


def test_month_arithmetic_keeps_time_and_clamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 8, 31, 17, 30),)], "t timestamp")
    r = df.select(X.add_months_keep_time("t", 18).alias("h")).first()
    assert r.h == dt.datetime(2026, 2, 28, 17, 30)


def test_unicode_strip(spark):
    df = spark.createDataFrame([(" \t Caps 　",), (None,)], "n string")
    out = clean.normalize_name(df, "n", "orig").collect()
    assert out[0].n == "caps" and out[0].orig == " \t Caps 　"
    assert out[1].n is None


def test_global_median_fallback_after_group_fill(spark):
    rows = [("A", 2024, 1.0), ("A", 2024, 3.0), ("A", 2024, None),
            ("B", 2024, None), ("B", 2024, None), ("C", 2024, 10.0)]
    df = spark.createDataFrame(rows, "league string, _source_year int, v double")
    out = clean.impute_group_median(df, ["v"]).collect()
    vals = sorted(r.v for r in out)
    # A's NULL -> 2 ; filled column = [1, 3, 2, 10] (+ B's NULLs) -> median 2.5
    assert vals == [1.0, 2.0, 2.5, 2.5, 3.0, 10.0]


def test_first_is_deterministic(spark):
    df = spark.createDataFrame([("k", "Second", dt.datetime(2024, 2, 1), 2),
                                ("k", None, dt.datetime(2023, 1, 1), 0),
                                ("k", "First", dt.datetime(2024, 1, 1), 1)],
                               "playername string, playername_original string, date timestamp, gameid int")
    r = serve.display_names(df, order=["date", "gameid"]).first()
    assert r.display_name == "First"


def test_precision_at_k_ties_by_id_and_k_zero(spark):
    df = spark.createDataFrame([(1, 0.9, 0), (2, 0.9, 1), (3, 0.1, 0)], "id int, s double, y int")
    r = metrics.precision_at_k(df, "y", "s", "id").first()
    assert r.k == 1 and r.precision_at_k == 0.0   # id 1 wins the tie and is negative
    z = spark.createDataFrame([(1, 0.9, 0)], "id int, s double, y int")
    r0 = metrics.precision_at_k(z, "y", "s", "id").first()
    assert r0.k == 0 and r0.precision_at_k is None


def test_silhouette_undefined_cases(spark):
    one = spark.createDataFrame([("p", 0, 1.0), ("p", 0, 2.0)], "position string, c int, x double")
    assert U.silhouette(one, "c", ["x"], ["position"]).first().silhouette is None
    allsing = spark.createDataFrame([("p", 0, 1.0), ("p", 1, 2.0)], "position string, c int, x double")
    assert U.silhouette(allsing, "c", ["x"], ["position"]).first().silhouette is None
    ok = spark.createDataFrame([("p", 0, 0.0), ("p", 0, 1.0), ("p", 1, 10.0), ("p", 1, 11.0)],
                               "position string, c int, x double")
    s = U.silhouette(ok, "c", ["x"], ["position"]).first().silhouette
    # squared distances: a = 1, b = mean(100, 121) or (81, 100) ...
    assert 0.9 < s <= 1.0


def test_nan_is_not_greater(spark):
    df = spark.createDataFrame([(float("nan"),)], "dpm_zscore double")
    out = U.archetypes(df.select(X.nan_to_null("dpm_zscore").alias("dpm_zscore"))).first()
    assert "High DPS" not in out.archetype


def test_join_small_broadcasts_only_when_proven(spark):
    from scoutlens.operators.joins import join_small
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint may broadcast
    try:
        yes = join_small(big, small, "k", "left")
        no = join_small(big, small, "k", "left", max_rows=5)
        plan_yes = yes._jdf.queryExecution().executedPlan().toString()
        plan_no = no._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan_yes
        assert "BroadcastHashJoin" not in plan_no
        assert sorted(yes.collect()) == sorted(no.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_strip_matches_python_isspace(spark):
    chars = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["　"]
    rows = [(f"{ch}Name{ch}",) for ch in chars] + [("﻿Bom",)]
    df = spark.createDataFrame(rows, "n string")
    got = [r.s for r in df.select(X.strip_unicode("n").alias("s")).collect()]
    assert got == [r[0].strip() for r in rows]
