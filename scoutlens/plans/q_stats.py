"""Queries: descriptive statistics, distributions and SQL-checkable metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..models import metrics
from ..operators import distributions as H
from ..operators import stats
from . import bindings as B
from . import flows
from .catalog import finish, query, sql_finish

W = B.with_ctes
M = ("m", B.M_SQL)
D = ("d", B.D_SQL)
V = ("v", B.V_SQL)
FC = flows.FEATURE_CTES
LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
D_COLS = B.D_FEATURES


def archetype_sql(prefix: str = "") -> str:
    """The archetype rules (config) as one DuckDB expression."""
    def v(f):
        return f"coalesce({prefix}{f}, 0.0::DOUBLE)"
    parts = []
    for label, conds in C.ARCHETYPE_RULES:
        cond = " AND ".join(f"{v(f)} > {t}::DOUBLE" for f, t in conds)
        parts.append(f"CASE WHEN {cond} THEN '{label}' END")
    bal = " AND ".join(f"abs({v(f)}) < {C.BALANCED_LIMIT}::DOUBLE" for f in C.BALANCED_FEATURES)
    parts.append(f"CASE WHEN {bal} THEN '{C.BALANCED_LABEL}' END")
    j = f"concat_ws('{C.LABEL_SEPARATOR}', {', '.join(parts)})"
    return f"CASE WHEN {j} = '' THEN '{C.NEUTRAL_ARCHETYPE}' ELSE {j} END"


@query("run_summary", W("""
SELECT count(*) AS n_rows, count(DISTINCT playername) AS n_players, count(DISTINCT league) AS n_leagues,
  array_to_string(list_sort(list_distinct(list(CAST(_source_year AS VARCHAR)))), ',') AS years FROM m""", M))
def run_summary(spark, d):
    return stats.run_summary(B.match(spark, d))


@query("home_kpis", W("""
SELECT count(DISTINCT playername) AS n_players, count(*) AS n_rows, count(DISTINCT league) AS n_leagues,
  count(DISTINCT CASE WHEN promoted_to_lec THEN playername END) AS n_promoted,
  array_to_string(list_sort(list_distinct(list(CAST(_source_year AS VARCHAR)))), ',') AS years FROM f""",
                      *FC))
def home_kpis(spark, d):
    return stats.kpis(flows.feature_table(spark, d))


CAT_ORDER = ["view", "click", "purchase", "signup", "refund"]


@query("counts_by_category", W("""
SELECT c.position, c.ord, CAST(n.n_rows AS DOUBLE) AS n_rows FROM (VALUES ('view', 0), ('click', 1), ('purchase', 2),
  ('signup', 3), ('refund', 4)) c(position, ord)
LEFT JOIN (SELECT position, count(*) AS n_rows FROM s GROUP BY position) n USING (position)""",
                               ("s", B.S_SQL)))
def counts_by_category(spark, d):
    # nullable integer columns are emitted as doubles (identical in both engines' frames)
    out = stats.counts_by(B.scores(spark, d), "position", CAT_ORDER)
    return out.withColumn("n_rows", F.col("n_rows").cast("double"))


@query("players_per_league", W(
    "SELECT league, count(DISTINCT playername) AS n_distinct FROM m GROUP BY league", M))
def players_per_league(spark, d):
    return stats.distinct_per(B.match(spark, d), "league", "playername")


@query("describe_numeric", sql_finish("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in LI_COLS)
    + ")", ["mean", "std", "min", "p25", "p50", "p75", "max"]))
def describe_numeric(spark, d):
    return finish(stats.describe_exact(B.table(spark, d, "lineitem"), LI_COLS))


@query("median_by_league", sql_finish(W("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT league, '{c}' AS \"column\", median({c}) AS median FROM m WHERE {c} IS NOT NULL "
    f"GROUP BY league" for c in ["kills", "dpm", "vspm"]) + ")", M), ["median"]))
def median_by_league(spark, d):
    return finish(stats.median_by(B.match(spark, d), "league", ["kills", "dpm", "vspm"]))


@query("class_mean_diff", sql_finish(W("SELECT *, CASE WHEN mean_neg <> 0 THEN (mean_pos - mean_neg) "
                                       "/ mean_neg * 100 END AS pct_diff FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN y = 0 THEN {c} END) AS mean_neg, "
    f"avg(CASE WHEN y = 1 THEN {c} END) AS mean_pos FROM d" for c in D_COLS) + ")", D),
    ["mean_neg", "mean_pos", "pct_diff"]))
def class_mean_diff(spark, d):
    return finish(stats.class_mean_diff(B.supervised(spark, d), "y", D_COLS))


@query("corr_matrix_long", sql_finish("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem"
    for a in LI_COLS for b in LI_COLS) + ")", ["r"]))
def corr_matrix_long(spark, d):
    return finish(stats.corr_matrix(B.table(spark, d, "lineitem"), LI_COLS))


@query("target_corr", sql_finish(W("SELECT *, abs(r) AS abs_r FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", corr(CAST(y AS DOUBLE), {c}) AS r FROM d" for c in D_COLS) + ")", D),
    ["r", "abs_r"]))
def target_corr(spark, d):
    return finish(stats.target_corr(B.supervised(spark, d), "y", D_COLS))


HC_COLS = LI_COLS + ["l_gross"]
HC_SRC = ("li", "SELECT *, l_extendedprice * (1 + l_tax) AS l_gross FROM lineitem")


@query("high_corr_pairs", sql_finish(W("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM li"
    for i, a in enumerate(HC_COLS) for b in HC_COLS[i + 1:]) + ") WHERE abs(r) > 0.9", HC_SRC), ["r"]))
def high_corr_pairs(spark, d):
    li = B.table(spark, d, "lineitem").withColumn(
        "l_gross", F.col("l_extendedprice") * (1 + F.col("l_tax")))
    return finish(stats.high_corr_pairs(li, HC_COLS, 0.9))


@query("champion_pool", W("""
SELECT playername, count(DISTINCT champion) AS pool_size,
       coalesce(bool_or(promoted_to_lec), false) AS promoted_to_lec FROM mt GROUP BY playername""",
                          *FC[:3]))
def champion_pool(spark, d):
    return stats.pool_by_class(flows.clean_match(spark, d), "playername", "champion",
                               "promoted_to_lec")


ZG = [f"{c}_zscore" for c in flows.Z_COLS]


@query("zscore_gap", sql_finish(W("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN win_rate > 0.5 THEN {c} END) - "
    f"avg(CASE WHEN NOT (win_rate > 0.5) THEN {c} END) AS gap FROM f" for c in ZG) + ")", *FC),
    ["gap"]))
def zscore_gap(spark, d):
    f = flows.feature_table(spark, d).withColumn("_y", F.col("win_rate") > 0.5)
    return finish(stats.z_gap(f, "_y", ZG))


@query("score_separation", sql_finish(W("""
SELECT median(score) FILTER (WHERE y = 1) AS median_pos, median(score) FILTER (WHERE y = 0) AS median_neg,
  CAST(count_if(y = 1) AS BIGINT) AS n_pos, CAST(count_if(y = 0) AS BIGINT) AS n_neg,
  median(score) FILTER (WHERE y = 1) - median(score) FILTER (WHERE y = 0) AS median_diff FROM d""", D),
    ["median_pos", "median_neg", "median_diff"]))
def score_separation(spark, d):
    return finish(stats.score_separation(B.supervised(spark, d), "y", "score"))


VC = ("vc", "SELECT *, CAST(row_id % 3 AS INTEGER) AS cluster FROM v")
PROF_SQL = ("prof", f"""
SELECT position, cluster, n_players, n_promoted, promo_rate, {archetype_sql('m_')} AS archetype,
  {', '.join(f'round(m_{f}, 4) AS {f}' for f in C.CLUSTER_FEATURES)}
FROM (SELECT position, cluster, count(*) AS n_players, CAST(count_if(promoted_to_lec) AS BIGINT) AS n_promoted,
  avg(CAST(promoted_to_lec AS INTEGER)) AS promo_rate,
  {', '.join(f'avg({f}) AS m_{f}' for f in C.CLUSTER_FEATURES)} FROM vc GROUP BY position, cluster)""")


def _profiles(spark, d):
    v = B.vectors(spark, d).withColumn("cluster", (F.col("row_id") % 3).cast("int"))
    return stats.cluster_profiles(v, "position", "cluster", "promoted_to_lec")


@query("cluster_profiles", sql_finish(W("SELECT * FROM prof", V, VC, PROF_SQL),
                                      ["promo_rate"] + C.CLUSTER_FEATURES))
def cluster_profiles(spark, d):
    return finish(_profiles(spark, d))


@query("profile_matrix", sql_finish(W("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT position, cluster, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM prof"
    for f in C.CLUSTER_FEATURES) + ")", V, VC, PROF_SQL), ["value"]))
def profile_matrix(spark, d):
    return finish(H.profile_matrix(_profiles(spark, d), "position", "cluster", C.CLUSTER_FEATURES))


@query("histogram", sql_finish(W("""
SELECT l_returnflag, bin, lo + bin * (hi - lo) / 50 AS lo, lo + (bin + 1) * (hi - lo) / 50 AS hi, count(*) AS n
FROM (SELECT l_returnflag, lo, hi, CAST(least(floor((x - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin
      FROM x JOIN r USING (l_returnflag))
GROUP BY l_returnflag, bin, lo, hi""",
    ("x", "SELECT l_returnflag, l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL"),
    ("r", "SELECT l_returnflag, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, "
          "CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM x GROUP BY ALL")),
    ["lo", "hi"]))
def histogram(spark, d):
    li = B.table(spark, d, "lineitem")
    return finish(H.histogram(li, "l_extendedprice", 50, ["l_returnflag"]))


@query("boxplot_summary", sql_finish(W("""
SELECT league, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3,
  CAST(min(CASE WHEN dpm >= q1 - 1.5 * (q3 - q1) THEN dpm END) AS DOUBLE) AS whisker_lo,
  CAST(max(CASE WHEN dpm <= q3 + 1.5 * (q3 - q1) THEN dpm END) AS DOUBLE) AS whisker_hi,
  CAST(count_if(dpm < q1 - 1.5 * (q3 - q1) OR dpm > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers, count(*) AS n
FROM m JOIN (SELECT league, quantile_cont(dpm, 0.25) AS q1, median(dpm) AS med,
                    quantile_cont(dpm, 0.75) AS q3 FROM m GROUP BY league) q USING (league)
WHERE dpm IS NOT NULL GROUP BY league""", M),
    ["q1", "median", "q3", "whisker_lo", "whisker_hi"]))
def boxplot_summary(spark, d):
    # quantiles, join-back and whisker pass all read the rows: stage them once
    return finish(H.boxplot(flows.stage(B.match(spark, d).select("league", "dpm")), "dpm", ["league"]))


RADAR_PLAYER = "s5"


@query("radar_vector", sql_finish(W(f"""
SELECT playername, axis, value FROM (
  SELECT playername, unnest([{', '.join(f"'{c}'" for c in ZG)}]) AS axis,
         unnest([{', '.join(ZG)}]) AS value
  FROM (SELECT * FROM f WHERE playername = '{RADAR_PLAYER}'
        ORDER BY win_rate DESC NULLS LAST, league, _source_year, position LIMIT 1))
WHERE value IS NOT NULL""", *FC), ["value"]))
def radar_vector(spark, d):
    f = flows.feature_table(spark, d).select("playername", "win_rate", "league", "_source_year",
                                             "position", *ZG)
    return finish(H.radar(f, "playername", RADAR_PLAYER, "win_rate", ZG,
                          ["league", "_source_year", "position"]))


# --- metrics over D ------------------------------------------------------------------------

THR = ("t", """
SELECT score AS threshold,
  sum(y) OVER (ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  count(*) OVER (ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   - sum(y) OVER (ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  sum(y) OVER () AS pos_tot, count(*) OVER () - sum(y) OVER () AS neg_tot,
  sum(y) OVER (PARTITION BY score) AS pos_eq, count(*) OVER (PARTITION BY score) - sum(y) OVER (PARTITION BY score) AS neg_eq
FROM d""")
THR_D = ("td", "SELECT DISTINCT * FROM t")


@query("pr_curve_points", sql_finish(W("""
SELECT threshold, CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, tp / (tp + fp) AS precision,
  CASE WHEN pos_tot > 0 THEN tp / pos_tot END AS recall, pos_tot / (pos_tot + neg_tot) AS baseline
FROM td""", D, THR, THR_D), ["threshold", "tp", "fp", "precision", "recall", "baseline"]))
def pr_curve_points(spark, d):
    return finish(metrics.pr_points(B.supervised(spark, d), "y", "score"))


@query("average_precision", sql_finish(W(
    "SELECT sum(CASE WHEN pos_tot > 0 THEN pos_eq / pos_tot * tp / (tp + fp) END) AS average_precision "
    "FROM td", D, THR, THR_D), ["average_precision"]))
def average_precision(spark, d):
    return finish(metrics.average_precision(B.supervised(spark, d), "y", "score"))


@query("roc_auc", sql_finish(W("""
SELECT CASE WHEN any_value(pos_tot * neg_tot) > 0 THEN
  sum(pos_eq * ((neg_tot - (fp - neg_eq) - neg_eq) + 0.5 * neg_eq)) / any_value(pos_tot * neg_tot) END AS roc_auc
FROM td""", D, THR, THR_D), ["roc_auc"]))
def roc_auc(spark, d):
    return finish(metrics.roc_auc(B.supervised(spark, d), "y", "score"))


@query("precision_at_k", sql_finish(W("""
SELECT k, CASE WHEN k > 0 THEN tp / k END AS precision_at_k, CASE WHEN k > 0 THEN tp / k END AS recall_at_k
FROM (SELECT (SELECT CAST(sum(y) AS BIGINT) FROM d) AS k,
             CAST(sum(y) FILTER (WHERE rn <= (SELECT sum(y) FROM d)) AS DOUBLE) AS tp
      FROM (SELECT y, row_number() OVER (ORDER BY score DESC, row_id) AS rn FROM d))""", D),
    ["precision_at_k", "recall_at_k"]))
def precision_at_k(spark, d):
    return finish(metrics.precision_at_k(B.supervised(spark, d), "y", "score", "row_id"))


@query("brier_score", sql_finish(W(
    "SELECT avg(pow(score / (SELECT max(score) FROM d) - y, 2)) AS brier FROM d", D), ["brier"]))
def brier_score(spark, d):
    df = B.supervised(spark, d)
    mx = df.agg(F.max("score")).scalar()
    return finish(metrics.brier(df.withColumn("p", F.col("score") / mx), "y", "p"))


@query("baseline_rate", sql_finish(W("SELECT avg(CAST(y AS DOUBLE)) AS baseline_rate FROM d", D),
                                   ["baseline_rate"]))
def baseline_rate(spark, d):
    return finish(metrics.baseline_rate(B.supervised(spark, d), "y"))


@query("class_weights", sql_finish(W("""
SELECT row_id, y, CASE WHEN y = 1 THEN n / (2.0 * pos) ELSE n / (2.0 * (n - pos)) END AS weight,
  (n - pos) / greatest(pos, 1) AS pos_weight
FROM d, (SELECT count(*) AS n, CAST(count_if(y = 1) AS BIGINT) AS pos FROM d) c""", D), ["weight", "pos_weight"]))
def class_weights(spark, d):
    out = metrics.class_weights(B.supervised(spark, d), "y")
    return finish(out.select("row_id", "y", "weight", F.col("pos_weight").cast("double")))


@query("grouped_folds", W("""
SELECT d.row_id, d."group", r.fold FROM d JOIN (
  SELECT "group", CAST((row_number() OVER (PARTITION BY label ORDER BY "group") - 1) % 5 AS INTEGER) AS fold
  FROM (SELECT "group", max(y) AS label FROM d GROUP BY "group")) r USING ("group")""", D))
def grouped_folds(spark, d):
    out = metrics.grouped_folds(B.supervised(spark, d), "group", "y", 5, order="name")
    return out.select("row_id", "group", "fold")


def _ap_auc_sql(col: str, name: str) -> str:
    return f"""SELECT '{name}' AS model,
  sum(CASE WHEN pos_tot > 0 THEN pos_eq / pos_tot * tp / (tp + fp) END) AS average_precision,
  CASE WHEN any_value(pos_tot * neg_tot) > 0 THEN sum(pos_eq * ((neg_tot - (fp - neg_eq) - neg_eq)
    + 0.5 * neg_eq)) / any_value(pos_tot * neg_tot) END AS roc_auc
FROM (SELECT DISTINCT {col} AS threshold,
  sum(y) OVER (ORDER BY {col} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  count(*) OVER (ORDER BY {col} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   - sum(y) OVER (ORDER BY {col} DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  sum(y) OVER () AS pos_tot, count(*) OVER () - sum(y) OVER () AS neg_tot,
  sum(y) OVER (PARTITION BY {col}) AS pos_eq,
  count(*) OVER (PARTITION BY {col}) - sum(y) OVER (PARTITION BY {col}) AS neg_eq FROM d)"""


@query("model_comparison", sql_finish(W(
    "SELECT *, CAST(row_number() OVER (ORDER BY average_precision DESC, model) AS INTEGER) AS rank "
    f"FROM ({_ap_auc_sql('f_chars', 'chars')} UNION ALL {_ap_auc_sql('f_words', 'words')})", D),
    ["average_precision", "roc_auc"]))
def model_comparison(spark, d):
    return finish(metrics.model_comparison(B.supervised(spark, d), "y",
                                           {"chars": "f_chars", "words": "f_words"}))
