"""The four stages end to end on a small export with the real 36-column schema."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.plans import stages
from scoutlens.sources import files

INT_STATS = ["kills", "deaths", "assists", "killsat15", "deathsat15", "assistsat15", "totalgold",
             "earnedgold", "minionkills", "monsterkills", "wardskilled", "wardsplaced",
             "damagetochampions", "gamelength"]
REAL_STATS = ["csat15", "csdiffat15", "golddiffat15", "xpdiffat15", "visionscore", "damageshare",
              "dpm", "cspm", "earnedgoldshare", "vspm"]
# players promoted to the top league: (feeder league, team index, position, debut date)
PROMOTED = {("LFL", 0, "top"): "2025-03-01 18:00:00", ("PRM", 1, "mid"): "2026-01-20 18:00:00",
            ("LFL", 2, "jng"): "2024-11-10 18:00:00", ("PRM", 3, "bot"): "2024-12-01 18:00:00"}


def _export(seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    cols = (["gameid", "league", "split", "date", "position", "playername", "teamname", "champion",
             "result"] + INT_STATS + REAL_STATS + ["patch"])
    for year in (2024, 2025):
        for league in ("LFL", "PRM"):
            for g in range(12):   # 4 teams, 6 games each per split
                day = dt.datetime(year, 1, 15, 18) + dt.timedelta(days=7 * g)
                pair = [(g + i) % 4 for i in (0, 1 + g % 3)]
                for side, t in enumerate(pair):
                    for pos in C.POSITIONS:
                        name = f"{league}_{t}_{pos}"
                        vals = [f"{league}_{year}_{g}", league, "Spring", str(day), pos,
                                f"  {name.upper() if pos == 'top' else name} ", f"{league} T{t}",
                                f"ch{rng.integers(0, 8)}", str(int(side == g % 2))]
                        vals += [str(int(rng.integers(0, 10))) for _ in INT_STATS]
                        vals += [f"{rng.normal(300 if c == 'dpm' else 1.0, 1):.3f}" for c in REAL_STATS]
                        if rng.random() < 0.05:
                            vals[-2] = ""          # missing vspm
                        rows.append(vals + ["14.1"])
                    team = [f"{league}_{year}_{g}", league, "Spring", str(day), "team", "",
                            f"{league} T{t}", "", str(int(side == g % 2))]
                    rows.append(team + ["0"] * len(INT_STATS) + ["0"] * len(REAL_STATS) + ["14.1"])
    for (league, t, pos), debut in PROMOTED.items():
        for j in range(2):   # debut game and one more in the top league
            d0 = dt.datetime.fromisoformat(debut) + dt.timedelta(days=7 * j)
            vals = [f"LEC_{debut}_{j}", "LEC", "Spring", str(d0), pos, f"{league}_{t}_{pos}",
                    "EU T", "ch1", "1"] + ["3"] * len(INT_STATS) + ["1.0"] * len(REAL_STATS) + ["14.1"]
            rows.append(vals)
    return cols, rows


@pytest.fixture(scope="module")
def raw_dir(spark):
    cols, rows = _export()
    df = spark.createDataFrame(rows, ",".join(f"`{c}` string" for c in cols))
    df = df.withColumn("year", F.year(F.to_timestamp("date")))
    return files.write_yearly_csv(df, files.stage_path(spark, "export"), "year")


def test_four_stages(spark, raw_dir):
    clean_df = stages.clean_stage(spark, raw_dir, [2024, 2025, 2026], pattern="year={year}",
                                  out=files.stage_path(spark, "clean"))
    assert clean_df.where(F.col("position") == "team").count() == 0
    assert clean_df.where(F.col("vspm").isNull()).count() == 0          # imputed
    pos_players = {r.playername for r in clean_df.where("promoted_to_lec")
                   .select("playername").distinct().collect()}
    assert pos_players == {"lfl_0_top", "prm_1_mid", "lfl_2_jng", "prm_3_bot"}
    fresh = stages.freshness_report(clean_df).first()
    assert fresh.data_max_date == "2026-01-27" and fresh.data_years == [2024, 2025, 2026]

    feats = stages.feature_stage(spark, clean_df, out=files.stage_path(spark, "features"))
    assert feats.where(F.col("games_played") < C.MIN_GAMES).count() == 0
    z = feats.groupBy("league", "_source_year", "split", "position").agg(
        F.avg("dpm_zscore").alias("m")).agg(F.max(F.abs("m"))).first()[0]
    assert z < 1e-9                                                      # centred per peer group

    res = stages.scoring_stage(spark, feats)
    comp = res["comparison"].collect()
    assert {r.model for r in comp} == {"logistic_regression", "random_forest"}
    sc = res["scores"].agg(F.min("talent_score"), F.max("talent_score"),
                           F.max("score_percentile")).first()
    assert 0 <= sc[0] <= sc[1] <= 100 and sc[2] == 100.0
    b = res["brier"].first()
    assert 0 <= b.brier_raw <= 1 and 0 <= b.brier_calibrated <= 1

    cl = stages.cluster_stage(spark, feats, ks=[2, 3], n_init=1, final_init=1, min_rows=5)
    assert cl["sweep"].count() == len(C.POSITIONS) * 2
    assert cl["profiles"].agg(F.sum("n_players")).first()[0] == cl["clusters"].count()
    assert cl["summary"].count() == len(C.POSITIONS)
