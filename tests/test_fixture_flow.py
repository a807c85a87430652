"""End to end on a tiny hand-made yearly export: files -> clean -> target -> features."""

import pytest
from pyspark.sql import functions as F

from scoutlens import config as C
from scoutlens.operators import clean, features, quality, target
from scoutlens.sources import files

COLS = ["gameid", "league", "split", "date", "position", "playername", "teamname", "champion",
        "result", "kills", "assists", "dpm"]


def _rows():
    rows = []
    for g in range(6):   # six LFL games in 2024 for two players, then one LEC debut
        for pos, name in (("top", "  FutureStar "), ("mid", "steady")):
            rows.append((f"G{g}", "LFL", "Spring", f"2024-0{1 + g % 6}-10 18:00:00", pos, name, "T1",
                         f"c{g % 3}", str(g % 2), "2", "3", str(300 + g)))
        rows.append((f"G{g}", "LFL", "Spring", f"2024-0{1 + g % 6}-10 18:00:00", "team", None,
                     "T1", None, str(g % 2), "4", "6", "600"))
    rows.append(("X1", "LEC", "Summer", "2024-09-01 18:00:00", "top", "futurestar", "EU", "c1",
                 "1", "1", "1", "250"))
    return rows


@pytest.fixture(scope="module")
def root(spark):
    df = spark.createDataFrame(_rows(), ",".join(f"{c} string" for c in COLS)) \
        .withColumn("year", F.lit(2024))
    return files.write_yearly_csv(df, files.stage_path(spark, "fixture"), "year")


def test_missing_columns_named_together(spark, root):
    with pytest.raises(quality.SchemaValidationError) as e:
        files.load_yearly(spark, root, [2024], pattern="year={year}", required=C.REQUIRED_COLUMNS)
    assert "deaths" in str(e.value) and "gamelength" in str(e.value)


def test_flow(spark, root):
    raw = files.load_yearly(spark, root, [2024, 2025], pattern="year={year}", required=COLS)
    typed = raw.select(*[F.col(c) for c in ("gameid", "league", "split", "date", "position",
                                            "playername", "teamname", "champion")],
                       *[F.col(c).try_cast("double").alias(c) for c in ("kills", "assists", "dpm")],
                       F.col("result").try_cast("int").alias("result"), "_source_year")
    kept = clean.filter_roles(clean.filter_targets(typed))
    assert kept.where(F.col("position") == "team").count() == 0
    m = clean.drop_missing(clean.normalize_name(kept))
    m = target.dated_target(m)
    pos = {r.playername for r in m.where("promoted_to_lec").collect()}
    assert pos == {"futurestar"}
    f = features.build_features(m)
    rows = {r.playername: r for r in f.collect()}
    assert set(rows) == {"futurestar", "steady"}          # LEC split has < 5 games
    assert rows["futurestar"].promoted_to_lec is True
    assert rows["futurestar"].games_played == 6
    assert rows["futurestar"].playername_original == "  FutureStar "
    # team kills per game = 2 + 2 = 4 -> (2 + 3) / 4 clipped to 1
    assert rows["steady"].killparticipation == 1.0
    assert rows["futurestar"].champion_pool_size == 3
