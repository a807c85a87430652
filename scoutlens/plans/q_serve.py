"""Queries: ranks, top-k, leaderboard, shortlist, lookups and scalar function groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import clean, rank, serve
from . import bindings as B
from .catalog import finish, query, sql_finish

W = B.with_ctes
S = ("s", B.S_SQL)
K = ("k", B.K_SQL)
P = ("prof", B.PROFILES_SQL)
M = ("m", B.M_SQL)
KEYS4 = ["playername", "position", "_source_year", "split"]
KEYS6 = ["playername", "league", "_source_year", "split", "position", "teamname"]
PCT_SQL = """(rank() OVER (PARTITION BY position ORDER BY talent_score)
  + (count(*) OVER (PARTITION BY position, talent_score) - 1) / 2.0)
  / count(*) OVER (PARTITION BY position) * 100"""


@query("score_percentile", sql_finish(W(
    f"SELECT row_id, position, talent_score, {PCT_SQL} AS score_percentile FROM s", S),
    ["talent_score", "score_percentile"]))
def score_percentile(spark, d):
    out = rank.percentile_rank_avg(B.scores(spark, d), ["position"], "talent_score")
    return finish(out.select("row_id", "position", "talent_score", "score_percentile"))


BEST_S = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
  ORDER BY talent_score DESC NULLS LAST, row_id) AS _rn FROM {src}) WHERE _rn = 1"""


@query("peak_season", sql_finish(W(
    "SELECT playername, row_id, position, talent_score FROM b", S,
    ("b", BEST_S.format(key="playername", src="s"))), ["talent_score"]))
def peak_season(spark, d):
    s = B.scores(spark, d).select("playername", "row_id", "position", "talent_score")
    return finish(rank.best_per(s, ["playername"], "talent_score", ["row_id"]))


@query("top_per_group", sql_finish(W("""
SELECT position, playername, row_id, talent_score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY position
         ORDER BY talent_score DESC NULLS LAST, playername, row_id) AS INTEGER) AS rank FROM b)
WHERE rank <= 3""", S, ("b", BEST_S.format(key="position, playername", src="s"))), ["talent_score"]))
def top_per_group(spark, d):
    s = B.scores(spark, d).select("position", "playername", "row_id", "talent_score")
    out = rank.top_per_group(s, ["position"], ["playername"], "talent_score", 3, ["row_id"])
    return finish(out.select("position", "playername", "row_id", "talent_score", "rank"))


@query("leaderboard_top20", sql_finish(W("""
SELECT row_id, playername, talent_score,
  CAST(row_number() OVER (ORDER BY talent_score DESC NULLS LAST, row_id) AS INTEGER) AS rank
FROM s ORDER BY talent_score DESC NULLS LAST, row_id LIMIT 20""", S), ["talent_score"]))
def leaderboard_top20(spark, d):
    out = rank.ranked(B.scores(spark, d), "talent_score", 20, ["row_id"])
    return finish(out.select("row_id", "playername", "talent_score", "rank"))


@query("season_history", sql_finish(W("""
SELECT gameid, _source_year, split, league, round(dpm, 1) AS dpm FROM mn WHERE playername = 's5'""",
                                      M, ("mn", B.MN_SQL)), ["dpm"]))
def season_history(spark, d):
    m = clean.normalize_name(B.match(spark, d))
    h = rank.season_history(m, "playername", "s5", "_source_year", "split")
    return finish(h.select("gameid", "_source_year", "split", "league", F.round("dpm", 1).alias("dpm")))


@query("top_percent_label", sql_finish(W(
    f"SELECT row_id, greatest(100.0 - {PCT_SQL}, 1.0) AS top_pct FROM s", S), ["top_pct"]))
def top_percent_label(spark, d):
    out = rank.percentile_rank_avg(B.scores(spark, d), ["position"], "talent_score")
    return finish(out.select("row_id", rank.top_percent().alias("top_pct")))


@query("leaderboard_filtered", sql_finish(W("""
SELECT row_id, playername, position, talent_score FROM s
WHERE position IN ('click', 'view') AND league IN ('click', 'view', 'purchase')
  AND _source_year = 2024 AND talent_score >= 50""", S), ["talent_score"]))
def leaderboard_filtered(spark, d):
    out = serve.leaderboard(B.scores(spark, d), "talent_score", ["click", "view"],
                            ["click", "view", "purchase"], 2024, 50)
    return finish(out.select("row_id", "playername", "position", "talent_score"))


SK = ("sk", """SELECT s.*, k.cluster,
  CASE WHEN k.cluster IS NULL THEN NULL ELSE coalesce(k.archetype, coalesce(prof.archetype, 'Inconnu')) END
    AS archetype
FROM s LEFT JOIN k USING (playername, position, _source_year, split)
LEFT JOIN prof ON lower(s.position) = prof.position AND k.cluster = prof.cluster""")


@query("shortlist", sql_finish(W("""
SELECT row_id, playername, position, cluster, archetype, talent_score FROM sk
WHERE position IN ('click', 'signup') AND talent_score >= 20 AND archetype = 'Carry agressif'""",
                                 S, K, P, SK), ["talent_score"]))
def shortlist(spark, d):
    s, k = B.scores(spark, d), B.clusters(spark, d)
    out = serve.shortlist(s, k, B.profiles_lookup(spark, d), KEYS4, positions=["click", "signup"],
                          min_score=20, archetype="Carry agressif")
    return finish(out.select("row_id", "playername", "position", "cluster", "archetype",
                             "talent_score"))


@query("style_search", sql_finish(W("""
SELECT playername, row_id, talent_score, archetype FROM (
  SELECT *, row_number() OVER (PARTITION BY playername ORDER BY talent_score DESC NULLS LAST, row_id) AS rn
  FROM sk WHERE position = 'click' AND contains(archetype, 'Carry')
    AND (league NOT IN ('view') OR league IS NULL)) WHERE rn = 1
ORDER BY talent_score DESC NULLS LAST, playername, row_id LIMIT 5""", S, K, P, SK), ["talent_score"]))
def style_search(spark, d):
    s, k = B.scores(spark, d), B.clusters(spark, d)
    sk = serve.shortlist(s, k, B.profiles_lookup(spark, d), KEYS4).select(
        "playername", "row_id", "talent_score", "archetype", "position", "league")
    out = serve.style_search(sk, "click", "Carry", ["view"], tiebreak=["row_id"])
    return finish(out.select("playername", "row_id", "talent_score", "archetype"))


@query("presentation_projection", sql_finish(W("""
SELECT row_id, coalesce(playername_original, CAST(playername AS VARCHAR)) AS display_name,
  coalesce(playername_original, CAST(playername AS VARCHAR)) || ' (' || league || ')' AS label,
  round(talent_score, 1) AS talent_score, round(win_rate, 3) AS win_rate,
  CASE WHEN promoted_to_lec THEN '✅' ELSE '❌' END AS promoted_to_lec, upper(position) AS position
FROM s""", S), ["talent_score", "win_rate"]))
def presentation_projection(spark, d):
    out = serve.present(B.scores(spark, d))
    return finish(out.select("row_id", "display_name", "label", "talent_score", "win_rate",
                             "promoted_to_lec", "position"))


@query("display_name_map", W("""
SELECT playername, arg_min(playername_original, date) AS display_name FROM mn
WHERE playername_original IS NOT NULL GROUP BY playername""", M, ("mn", B.MN_SQL)))
def display_name_map(spark, d):
    m = clean.normalize_name(B.match(spark, d))
    return serve.display_names(m, "playername", "playername_original", ["date", "gameid"])


@query("option_lists", W("SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM s WHERE {c} IS NOT NULL"
    for c in ["position", "league", "split", "_source_year"]) + ")", S))
def option_lists(spark, d):
    return serve.option_lists(B.scores(spark, d), ["position", "league", "split", "_source_year"])


@query("score_cluster_left", sql_finish(W("""
SELECT s.row_id, s.playername, s.talent_score, k.cluster, k.archetype FROM s
LEFT JOIN k USING (playername, position, _source_year, split)""", S, K), ["talent_score"]))
def score_cluster_left(spark, d):
    out = serve.attach_clusters(B.scores(spark, d), B.clusters(spark, d), KEYS4)
    return finish(out.select("row_id", "playername", "talent_score", "cluster", "archetype"))


@query("score_cluster_inner", sql_finish(W("""
SELECT s.row_id, s.playername, s.talent_score, k.cluster, k.archetype FROM s
JOIN k USING (playername, league, _source_year, split, position, teamname)""", S, K), ["talent_score"]))
def score_cluster_inner(spark, d):
    out = serve.attach_clusters(B.scores(spark, d), B.clusters(spark, d), KEYS6, "inner")
    return finish(out.select("row_id", "playername", "talent_score", "cluster", "archetype"))


@query("archetype_lookup", W("""
SELECT s.row_id, k.cluster, coalesce(prof.archetype, 'Inconnu') AS archetype_lookup FROM s
LEFT JOIN k USING (playername, position, _source_year, split)
LEFT JOIN prof ON lower(s.position) = prof.position AND k.cluster = prof.cluster""", S, K, P))
def archetype_lookup(spark, d):
    j = serve.attach_clusters(B.scores(spark, d), B.clusters(spark, d), KEYS4)
    out = serve.attach_archetype(j, B.profiles_lookup(spark, d))
    return out.select("row_id", "cluster", "archetype_lookup")


BM_ORDER = ["position", "_source_year", "split", "teamname"]


@query("best_match_lookup", W("""
SELECT playername, row_id, match_cluster, match_position, match_split FROM (
  SELECT r.playername, r.row_id, c.cluster AS match_cluster, c.position AS match_position,
         c.split AS match_split,
         row_number() OVER (PARTITION BY r.row_id ORDER BY
           CASE WHEN c.position = r.position THEN
             CASE WHEN c._source_year = r._source_year THEN
               CASE WHEN c.split = r.split THEN 3 ELSE 2 END ELSE 1 END ELSE 0 END DESC,
           c.position, c._source_year, c.split, c.teamname) AS rn
  FROM r LEFT JOIN k c USING (playername)) WHERE rn = 1""", S, K,
    ("r", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY playername ORDER BY "
          "talent_score DESC NULLS LAST, row_id) AS _rn FROM s) WHERE _rn = 1")))
def best_match_lookup(spark, d):
    s, k = B.scores(spark, d), B.clusters(spark, d)
    s = s.select("playername", "row_id", "position", "_source_year", "split", "talent_score")
    ref = rank.best_per(s, ["playername"], "talent_score", ["row_id"])
    out = serve.best_match(ref, k, "playername", ["position", "_source_year", "split"], BM_ORDER,
                           ["cluster", "position", "split"])
    return out.select("playername", "row_id", "match_cluster", "match_position", "match_split")


@query("same_cluster_similar", sql_finish(W("""
SELECT row_id, playername, position, cluster, talent_score, is_reference FROM (
  SELECT *, true AS is_reference FROM ref UNION ALL
  SELECT sk.*, false FROM sk JOIN ref r2 ON sk.position = r2.position AND sk.cluster = r2.cluster
  WHERE sk.playername <> 7)""", S, K, P, SK,
    ("ref", "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY playername ORDER BY "
            "talent_score DESC NULLS LAST, row_id) AS _rn FROM sk WHERE playername = 7) WHERE _rn = 1")),
    ["talent_score"]))
def same_cluster_similar(spark, d):
    s, k = B.scores(spark, d), B.clusters(spark, d)
    sk = serve.shortlist(s, k, B.profiles_lookup(spark, d), KEYS4).select(
        "row_id", "playername", "position", "cluster", "talent_score")
    out = serve.same_cluster(sk, "playername", 7, "talent_score", ["row_id"])
    return finish(out.select("row_id", "playername", "position", "cluster", "talent_score",
                             "is_reference"))


# --- X: scalar function groups ---------------------------------------------------------

@query("scalar_strings", W("""
SELECT p_partkey, lower(p_name) AS name_lower, upper(p_brand) AS brand_upper,
  lower(trim('  ' || p_brand || ' ')) AS brand_key,
  contains(lower(p_type), 'brass') OR contains('brass', lower(p_type)) AS is_brass,
  replace(p_type, ' BRASS', '') AS type_base,
  concat_ws(' | ', p_brand, p_type) AS brand_type, p_name || ' (' || p_brand || ')' AS label
FROM part"""))
def scalar_strings(spark, d):
    p = B.table(spark, d, "part")
    return p.select(
        "p_partkey", F.lower("p_name").alias("name_lower"), F.upper("p_brand").alias("brand_upper"),
        X.normalize_key(F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))).alias("brand_key"),
        X.contains_either("p_type", F.lit("BRASS")).alias("is_brass"),
        F.replace(F.col("p_type"), F.lit(" BRASS"), F.lit("")).alias("type_base"),
        F.concat_ws(" | ", "p_brand", "p_type").alias("brand_type"),
        X.label("p_name", "p_brand").alias("label"))


@query("scalar_dates", sql_finish(W("""
SELECT o_orderkey, strftime(CAST(o_orderdate AS VARCHAR)::TIMESTAMP + INTERVAL 18 MONTH, '%Y-%m-%d %H:%M:%S') AS horizon,
  strftime(o_orderdate, '%Y-%m-%d') AS iso_day, CAST(year(o_orderdate) AS INTEGER) AS year,
  TRY_CAST('not a date' || CAST(o_orderkey % 2 AS VARCHAR) AS TIMESTAMP) AS bad
FROM orders"""), stamps=["bad"]))
def scalar_dates(spark, d):
    o = B.table(spark, d, "orders")
    ts = X.parse_ts(F.col("o_orderdate").cast("string"))
    return finish(o.select(
        "o_orderkey",
        F.date_format(X.add_months_keep_time(ts, 18), "yyyy-MM-dd HH:mm:ss").alias("horizon"),
        X.iso_day("o_orderdate").alias("iso_day"), F.year("o_orderdate").alias("year"),
        X.parse_ts(F.concat(F.lit("not a date"), (F.col("o_orderkey") % 2).cast("string")))
        .alias("bad")))


@query("scalar_numeric", sql_finish("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount > 0 THEN l_tax / l_discount ELSE 0.0 END AS tax_ratio,
  least(greatest(l_discount * 10, 0.0::DOUBLE), 0.5::DOUBLE) AS clipped,
  abs(l_quantity - 25) AS dist25, round(l_extendedprice / 7, 3) AS r3,
  greatest(l_quantity - 40, 1.0::DOUBLE) AS floored,
  TRY_CAST(CASE WHEN l_linenumber = 1 THEN 'x' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) AS num
FROM lineitem""", ["tax_ratio", "clipped", "dist25", "r3", "floored", "num"]))
def scalar_numeric(spark, d):
    li = B.table(spark, d, "lineitem")
    txt = F.when(F.col("l_linenumber") == 1, F.lit("x")).otherwise(F.col("l_quantity").cast("string"))
    return finish(li.select(
        "l_orderkey", "l_linenumber",
        X.safe_ratio("l_tax", "l_discount").alias("tax_ratio"),
        X.clip(F.col("l_discount") * 10, 0.0, 0.5).alias("clipped"),
        F.abs(F.col("l_quantity") - 25).alias("dist25"),
        F.round(F.col("l_extendedprice") / 7, 3).alias("r3"),
        X.floor_at(F.col("l_quantity") - 40, 1.0).alias("floored"),
        X.to_number(txt).alias("num")))


@query("scalar_null_bool", sql_finish(W("""
SELECT gameid, assists, coalesce(vspm, 0.0) AS vspm0,
  lower(trim(CASE WHEN result = 1 THEN ' True' ELSE 'False ' END)) IN ('true', '1', '1.0') AS won,
  league IN ('1-URGENT', '2-HIGH') AS is_top2, (league NOT IN ('5-LOW') OR league IS NULL) AS not_low
FROM m""", M), ["assists", "vspm0"]))
def scalar_null_bool(spark, d):
    m = B.match(spark, d)
    txt = F.when(F.col("result") == 1, F.lit(" True")).otherwise(F.lit("False "))
    return finish(m.select(
        "gameid", "assists", F.coalesce("vspm", F.lit(0.0)).alias("vspm0"),
        X.text_bool(txt).alias("won"), F.col("league").isin("1-URGENT", "2-HIGH").alias("is_top2"),
        X.not_in("league", ["5-LOW"]).alias("not_low")))


@query("bool_repair", W("""
SELECT gameid, assists, lower(trim(CASE WHEN result = 1 THEN 'True' ELSE 'False' END)) IN ('true', '1', '1.0')
  AS result_bool FROM m""", M))
def bool_repair(spark, d):
    from ..sources import files
    m = B.match(spark, d).withColumn(
        "result_txt", F.when(F.col("result") == 1, "True").otherwise("False"))
    out = files.repair_booleans(m, ["result_txt"])
    return out.select("gameid", "assists", F.col("result_txt").alias("result_bool"))


@query("scalar_nested", W("""
SELECT user_id, array_to_string(list_sort(list_distinct(list(CAST(json_extract(props, '$.k') AS INTEGER)))), ',') AS ks,
  count(*) AS n, to_json({'user': user_id, 'n': count(*)}) AS js
FROM events GROUP BY user_id"""))
def scalar_nested(spark, d):
    e = B.table(spark, d, "events")
    k = F.from_json("props", "k int")["k"]
    g = e.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set(k)), ",").alias("ks"), F.count("*").alias("n"))
    return g.withColumn("js", F.to_json(F.struct(F.col("user_id").alias("user"), F.col("n"))))
