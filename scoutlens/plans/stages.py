"""End-to-end stages on the real match-export schema.

Each stage reads the previous stage table, runs one lazy plan and writes a
parquet stage table partitioned by ``_source_year`` (plus small JSON reports),
like the reference's refresh flow:

    clean_stage    yearly CSVs -> checked, filtered, normalised, imputed, dated target
    feature_stage  clean table -> participation, per-split aggregate, min games, z-scores
    scoring_stage  features -> out-of-time split, LR / RF (+ GBT), comparison, calibration,
                   scores with per-position percentiles
    cluster_stage  features -> per-position k sweep, final K-Means, PCA, profiles

All paths may be HDFS / object-store URIs.
"""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import parse_ts, to_number
from ..models import cluster as U
from ..models import metrics
from ..models import supervised as S
from ..operators import clean, features, quality, stats, target
from ..sources import files

TEXT_COLS = ["gameid", "league", "split", "date", "position", "playername", "teamname", "champion"]


def type_columns(raw: DataFrame) -> DataFrame:
    """Text export -> typed columns (coercing: bad numbers / dates become NULL)."""
    out = []
    for c in raw.columns:
        if c in TEXT_COLS:
            out.append(F.col(c))
        elif c == "_source_year":
            out.append(F.col(c).cast("int"))
        elif c == "result":
            out.append(to_number(c).cast("int").alias(c))
        else:
            out.append(to_number(c).alias(c))
    typed = raw.select(*out)
    return typed.withColumn("date", parse_ts("date")) if "date" in typed.columns else typed


def clean_stage(spark: SparkSession, raw_dir: str, years, out: str | None = None,
                pattern: str = "{year}_*.csv", horizon: int = C.HORIZON_MONTHS) -> DataFrame:
    """§3.1: read + check -> filters -> projection -> names -> missing values -> target."""
    raw = files.load_yearly(spark, raw_dir, list(years), pattern, required=C.REQUIRED_COLUMNS,
                            optional=C.OPTIONAL_COLUMNS, numeric=C.NUMERIC_CHECK_COLUMNS)
    raw = raw.withColumn("_row", F.monotonically_increasing_id())   # order of the files and their lines
    df, _missing = clean.select_known(raw, C.KEY_COLUMNS, extra=("_source_year", "_row"))
    df = type_columns(df)
    df = clean.filter_roles(clean.filter_targets(df, C.ALL_TARGET_LEAGUES, order_col="_row")).drop("_row")
    df = clean.normalize_name(df)
    df = files.materialize(clean.drop_missing(df), "clean")    # read by every pass of the imputation
    df = clean.impute_group_median(df)
    df = clean.fill_unknown(df)
    df = target.dated_target(df, horizon)
    if out:
        files.write_stage(df, out)
        return files.read_stage(spark, out)
    return df


def feature_stage(spark: SparkSession, clean_df: DataFrame, out: str | None = None) -> DataFrame:
    """§3.2 first half: one row per player x split with peer z-scores."""
    f = features.build_features(clean_df)
    if out:
        files.write_stage(f, out)
        return files.read_stage(spark, out)
    return f


def scoring_stage(spark: SparkSession, feats: DataFrame, out: str | None = None,
                  with_gbt: bool = False, tune: dict | None = None) -> dict:
    """§3.2 second half: train on the train years, compare on the test years, calibrate,
    score every feeder row. Returns {'comparison', 'scores', 'importances'} DataFrames.

    ``tune``: arguments of the forest's randomised search (``{}``: the full grid); the
    refitted best draw then competes as ``random_forest_tuned`` and the result has
    ``search``."""
    cols = S.feature_columns(feats)
    split = S.oot_split(feats).withColumn(C.DEFAULT_ROLES.target,
                                          F.col(C.DEFAULT_ROLES.target).cast("int"))
    train = split.where(F.col("part") == "train")
    test = split.where(F.col("part") == "test")
    y = C.DEFAULT_ROLES.target
    models = {"logistic_regression": S.train_lr(train, cols, y),
              "random_forest": S.train_rf(train, cols, y)}
    if with_gbt:
        models["gbt"] = S.train_gbt(train, cols, y)
    search, tuned_args = None, {}
    if tune is not None:
        search, models["random_forest_tuned"] = S.tuned_rf(train, cols, y, C.DEFAULT_ROLES.player, **tune)
        tuned_args = ast.literal_eval(search.where("is_best").first()["params"])
    scored = test
    for name, m in models.items():
        p = S.positive_probability(m, test, cols, f"p_{name}").select("playername", "league",
                                                                      "_source_year", "split",
                                                                      "position", "teamname",
                                                                      f"p_{name}")
        scored = scored.join(p, ["playername", "league", "_source_year", "split", "position",
                                 "teamname"], "left")
    comparison = metrics.model_comparison(scored, y, {n: f"p_{n}" for n in models})
    best_name = comparison.orderBy("rank").first()["model"]   # one row of a tiny table
    trainers = {"logistic_regression": lambda d: S.train_lr(d, cols, y),
                "random_forest": lambda d: S.train_rf(d, cols, y),
                "random_forest_tuned": lambda d: S.train_forest(d, cols, y, **tuned_args),
                "gbt": lambda d: S.train_gbt(d, cols, y)}
    fitted = S.fit_calibrated(train, cols, y, train_fn=trainers[best_name])
    raw_test = S.positive_probability(models[best_name], test, cols, "p_raw")
    cal_test = S.apply_calibrated(fitted, raw_test, cols)
    brier = metrics.brier(cal_test, y, "p_raw", "brier_raw").select(
        "brier_raw", metrics.brier(cal_test, y, "p_calibrated", "b").select("b").scalar()
        .alias("brier_calibrated"))
    feeders = split.drop("part")
    scores = S.score_probability(S.apply_calibrated(fitted, feeders, cols), "p_calibrated")
    imps = S.importances(models[best_name], cols)
    if out:
        files.write_stage(scores, f"{out}/scores")
        files.write_json(comparison, f"{out}/comparison", single_file=True)
        files.write_json(imps, f"{out}/importances", single_file=True)
    return {"comparison": comparison, "scores": scores, "importances": imps, "brier": brier, "search": search}


def cluster_stage(spark: SparkSession, feats: DataFrame, out: str | None = None,
                  ks=C.K_RANGE, n_init: int = 10, final_init: int = 20,
                  min_rows: int = C.MIN_ROWS_TO_CLUSTER) -> dict:
    """§3.3: per-position k sweep, final K-Means at the best k, PCA, profiles."""
    feeders = feats.where(F.col("league").isin(C.FEEDER_LEAGUES))
    cols = [c for c in C.CLUSTER_FEATURES if c in feeders.columns]
    sweep = U.k_sweep(feeders, cols, "position", ks=ks, n_init=n_init, min_rows=min_rows)
    labelled = U.cluster_by_position(feeders, cols, sweep.where("is_best"), n_init=final_init,
                                     min_rows=min_rows)
    emb = U.embed_2d(labelled.where(F.col("cluster") >= 0), cols)
    prof = stats.cluster_profiles(labelled.where(F.col("cluster") >= 0), "position", "cluster",
                                  C.DEFAULT_ROLES.target, cols)
    best = U.best_k(sweep, ["position"])
    summary = stats.position_summary(prof, best)
    if out:
        files.write_stage(emb, f"{out}/clusters")
        files.write_json(files.profiles_document(prof), f"{out}/profiles", single_file=True)
        files.write_json(sweep, f"{out}/k_scores", single_file=True)
    return {"sweep": sweep, "clusters": emb, "profiles": prof, "summary": summary}


def freshness_report(clean_df: DataFrame) -> DataFrame:
    """Run metadata written after cleaning (Q-B4)."""
    return quality.freshness(clean_df)
