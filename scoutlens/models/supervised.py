"""Supervised promotion scoring with Spark ML (M-S1 … M-S6, M-S11, M-S13, M-S15, M-S16).

Parity of *definitions* with the reference, not of solver bits:

* logistic regression: standardise (mean + std), L2 with C = 0.1 and balanced
  class weights: ½‖w‖²/C + Σ wᵢ·lossᵢ, by Newton's method for all folds at once (:mod:`.newton`);
* random forest / gradient-boosted trees with the reference's sizes and class
  weighting through ``weightCol``;
* Platt calibration: per fold, the base model is refitted on the other folds
  and a one-feature logistic regression is fitted on the held-out margins with
  Platt's smoothed targets (each held-out row enters twice, as label 1 with
  weight t and label 0 with weight 1 − t); the calibrated probability is the
  mean over the folds' (model, calibrator) pairs.

Training data are stage tables; nothing is collected except model parameters and
per-fold scalar metrics.
"""

from __future__ import annotations

import ast
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.rank import percentile_rank_avg
from ..session import materialize
from . import forest, metrics, newton

LOGISTIC = "logistic"      # folder of a saved logistic regression


def oot_split(df: DataFrame, train_years=C.TRAIN_YEARS, test_years=C.TEST_YEARS,
              feeders=C.FEEDER_LEAGUES, year_col: str = "_source_year",
              league_col: str = "league", out: str = "part") -> DataFrame:
    """M-S1: feeder rows only, tagged 'train' / 'test' / NULL (neither) by year."""
    f = df.where(F.col(league_col).isin(list(feeders)))
    y = F.col(year_col)
    return f.withColumn(out, F.when(y.isin(list(train_years)), "train")
                        .when(y.isin(list(test_years)), "test"))


def feature_columns(df: DataFrame, cols=C.MODEL_FEATURES) -> list[str]:
    return [c for c in cols if c in df.columns]


def fill_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """M-S2: missing feature values -> 0 (listed columns that exist)."""
    return df.fillna(0.0, subset=cols).select(
        *[c for c in df.columns if c not in cols], *[F.col(c).cast("double").alias(c) for c in cols])


def _assembler(cols):
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def _label(df: DataFrame, y: str) -> DataFrame:
    return df.withColumn("label", F.col(y).cast("int").cast("double"))


def with_balanced_weights(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    return metrics.class_weights(_label(df, y), "label", out).drop("pos_weight")


def train_lr(df: DataFrame, cols: list[str], y: str, c: float = C.LR_C) -> newton.Logistic:
    """M-S4: standardised, L2 (C), balanced logistic regression, solved by Newton's method to its optimum."""
    return newton.fit(df, cols, y, c)


def train_rf(df: DataFrame, cols: list[str], y: str, num_trees: int = C.RF_TREES,
             max_depth: int = C.RF_DEPTH, min_instances: int = 1, seed: int = C.SEED,
             feature_subset: str = "sqrt") -> PipelineModel:
    """M-S5: balanced random forest."""
    data = with_balanced_weights(fill_features(df, cols), y)
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                minInstancesPerNode=min_instances,
                                featureSubsetStrategy=feature_subset)
    return _fit_staged(data, cols, rf)


def train_gbt(df: DataFrame, cols: list[str], y: str, rounds: int = C.GBT_ROUNDS,
              depth: int = C.GBT_DEPTH, step: float = C.GBT_STEP, seed: int = C.SEED) -> PipelineModel:
    """M-S6: gradient-boosted trees; positives weighted by neg / max(pos, 1)."""
    data = metrics.class_weights(_label(fill_features(df, cols), y), "label", "_bal")
    data = data.withColumn("weight", F.when(F.col("label") == 1, F.col("pos_weight"))
                           .otherwise(F.lit(1.0)))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                        maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)
    return _fit_staged(data, cols, gbt)


def _fit_staged(data: DataFrame, cols: list[str], estimator) -> PipelineModel:
    """Assemble once into a stage table of (features, label, weight) for the iterative
    learner, and return assembler + model as one PipelineModel."""
    asm = _assembler(cols)
    model = estimator.fit(materialize(asm.transform(data).select("features", "label", "weight"), "training"))
    return PipelineModel(stages=[asm, model])


def positive_probability(model: PipelineModel, df: DataFrame, cols: list[str],
                         out: str = "p") -> DataFrame:
    filled = fill_features(df, cols)
    if isinstance(model, newton.Logistic):
        return filled.withColumn(out, model.probability())
    pred = model.transform(filled)
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1]).drop(
        "features", "sampled", "scaled", "rawPrediction", "probability", "prediction")


def importances(model: PipelineModel, cols: list[str]) -> DataFrame:
    """M-S11: |coefficient| (linear) or impurity importance (trees), normalised to 1."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        vals = [abs(float(v)) for v in last.coefficients.toArray()]
    else:
        vals = [float(v) for v in last.featureImportances.toArray()]
    tot = sum(vals) or 1.0
    rows = sorted(((c, v / tot) for c, v in zip(cols, vals)), key=lambda r: -r[1])
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def _ranked(scored: DataFrame, part: str, score: str) -> DataFrame:
    """Percentiles of a stage table of the scores: ranking filters and reads a score several times, and
    each time would run the models (and what their features are made of) again."""
    return percentile_rank_avg(materialize(scored, "scored"), [part], score).orderBy(F.col(score).desc())


def score_all(model: PipelineModel, df: DataFrame, cols: list[str],
              part: str = "position", feeders=None, league_col: str = "league",
              score: str = "talent_score") -> DataFrame:
    """M-S16: probability x 100 and the per-position average-rank percentile."""
    base = df if feeders is None else df.where(F.col(league_col).isin(list(feeders)))
    p = positive_probability(model, base, cols, "_p").withColumn(score, F.col("_p") * 100) \
        .drop("_p", "label", "weight")
    return _ranked(p, part, score)


def fit_calibrated(df: DataFrame, cols: list[str], y: str, k: int = C.CALIBRATION_FOLDS,
                   seed: int = C.SEED, fold_col: str | None = None, train_fn=None, at_once: int = 1) -> list:
    """M-S15 (fit): ``k`` (base model, Platt a, Platt b) triples, one per fold.

    Per fold the base model is refitted on the other folds and a one-feature
    logistic regression is fitted on the held-out margins with Platt's targets
    t+ = (N+ + 1)/(N+ + 2), t- = 1/(N- + 2) (each held-out row enters as label 1
    with weight t and as label 0 with weight 1 - t). Folds are stratified by
    class like the reference's, or given by ``fold_col`` (e.g. grouped folds). ``at_once``: how many
    folds' models of ``train_fn`` are fitted side by side.
    """
    base = fill_features(df, cols)
    if fold_col is None:
        # stratified row folds (round-robin inside each class, pseudo-random order)
        base = materialize(base.withColumn("_rid", F.monotonically_increasing_id()), "rows")
        base = materialize(metrics.grouped_folds(base, "_rid", y, k, seed, out="_fold"), "folds")
        fold_col = "_fold"
    fitted = []
    if train_fn is None:                                  # all folds' models, then all calibrations, at once
        fitted = newton.fit_folds(base, cols, y, C.LR_C, fold_col, k)

    def one(i: int):
        part = base.where(F.col(fold_col) != i)
        classes = part.agg(F.min(F.col(y).cast("int")).alias("lo"), F.max(F.col(y).cast("int")).alias("hi")).first()
        if classes["lo"] == classes["hi"]:
            return None                                   # one class (or no row): nothing to learn
        model = train_fn(part)
        held = model.transform(base.where(F.col(fold_col) == i))
        held = materialize(_label(held.select(_calibration_input(model).alias("_m"), F.col(y)), y), "held-out")
        cnt = held.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
        pos, neg = cnt["p"] or 0, cnt["n"] - (cnt["p"] or 0)
        if not cnt["n"]:
            return None
        t = F.when(F.col("label") == 1, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2))
        soft = held.select(F.lit(0).cast("long").alias("fold"), t.alias("y"), F.array("_m").alias("x"))
        b, a = newton.solve(soft, [newton.Problem(None, False, (1.0, 1.0), np.zeros(1), np.ones(1), 0.0)])[0]
        return model, float(a), float(b)

    if train_fn and at_once > 1:
        with ThreadPool(min(at_once, k)) as pool:
            fitted = [f for f in pool.map(one, range(k), 1) if f]
    elif train_fn:
        fitted = [f for f in map(one, range(k)) if f]
    if not fitted:
        raise ValueError("calibration needs rows of both classes outside some fold")
    return fitted


def _calibration_input(model: PipelineModel):
    """Platt input: the decision margin of a linear model (finite, because a
    fold without both classes is never fitted), else the positive-class
    probability (trees have no decision function)."""
    if isinstance(model, newton.Logistic):
        return model.margin()
    if hasattr(model.stages[-1], "coefficients"):
        return vector_to_array(F.col("rawPrediction"))[1]
    return vector_to_array(F.col("probability"))[1]


def apply_calibrated(fitted: list, df: DataFrame, cols: list[str],
                     out: str = "p_calibrated") -> DataFrame:
    """M-S15 (apply): mean over the folds of sigmoid(a * margin_k(x) + b)."""
    drop = ("features", "sampled", "scaled", "rawPrediction", "probability", "prediction")
    scored = fill_features(df, cols)
    for i, (model, a, b) in enumerate(fitted):
        m = _calibration_input(model)
        seen = scored if isinstance(model, newton.Logistic) else model.transform(scored)
        scored = seen.withColumn(f"_p{i}", 1 / (1 + F.exp(-(a * m + b)))).drop(*drop)
    mean = sum(F.col(f"_p{i}") for i in range(len(fitted))) / len(fitted)
    return scored.withColumn(out, mean).drop(*[f"_p{i}" for i in range(len(fitted))])


def calibrated_scores(df: DataFrame, cols: list[str], y: str, k: int = C.CALIBRATION_FOLDS,
                      seed: int = C.SEED, fold_col: str | None = None, train_fn=None,
                      out: str = "p_calibrated") -> DataFrame:
    """M-S15: Platt-calibrated ensemble of ``k`` fold models, applied to ``df``."""
    fitted = fit_calibrated(df, cols, y, k, seed, fold_col, train_fn)
    return apply_calibrated(fitted, df, cols, out)


def score_probability(df: DataFrame, p: str, part: str = "position",
                      score: str = "talent_score") -> DataFrame:
    """M-S16 from a probability column: score = p x 100, per-position percentile."""
    return _ranked(df.withColumn(score, F.col(p) * 100), part, score)


def tune_rf(df: DataFrame, cols: list[str], y: str, group: str, grid: dict = C.RF_GRID, n_iter: int = C.SEARCH_DRAWS,
            folds: int = C.SEARCH_FOLDS, seed: int = C.SEED) -> DataFrame:
    """M-S13: randomised search over ``grid`` with grouped folds and step-wise average precision;
    all forests of all draws and folds are grown together (:mod:`.forest`). One row per draw with its
    mean average precision, the best marked; :func:`tuned_rf` also refits the best on all rows."""
    return forest.search(df, cols, y, group, grid, n_iter, folds, seed)


def tuned_rf(df: DataFrame, cols: list[str], y: str, group: str, grid: dict = C.RF_GRID,
             n_iter: int = C.SEARCH_DRAWS, folds: int = C.SEARCH_FOLDS, seed: int = C.SEED):
    """M-S13 to its end: (search table, the best draw's forest refitted on all rows)."""
    search = tune_rf(df, cols, y, group, grid, n_iter, folds, seed)
    return search, train_forest(df, cols, y, seed=seed, **best_params(search))


def best_params(search: DataFrame) -> dict:
    """The parameters of a search's best draw."""
    return ast.literal_eval(search.where("is_best").first()["params"])


def train_forest(df: DataFrame, cols: list[str], y: str, seed: int = C.SEED, **params) -> forest.Forest:
    """One histogram forest with the search's parameters."""
    return forest.fit(df, cols, y, forest.Spec(0, seed=seed, **params))


def save_model(model, path: str) -> str:
    """S-A7: persist a fitted model: a pipeline in Spark ML's format, a logistic regression as one JSON line."""
    if isinstance(model, newton.Logistic):
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(model.document(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{LOGISTIC}")
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """S-A7: load a persisted model."""
    try:
        rows = SparkSession.getActiveSession().read.text(f"{path}/{LOGISTIC}")
    except AnalysisException:                             # no such folder: a pipeline
        return PipelineModel.load(path)
    return newton.Logistic.of(rows.first()["value"])
