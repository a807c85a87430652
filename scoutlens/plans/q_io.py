"""Queries: file sources and sinks (round trips through the shared stage folder)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats
from ..sources import appearances, files
from . import bindings as B
from . import flows
from .catalog import finish, query, sql_finish
from .q_stats import PROF_SQL, VC

W = B.with_ctes
YEARS = list(range(1995, 2002)) + [2030]   # 2030 has no file: skipped with a warning


@query("yearly_scan_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS _source_year, count(*) AS n_rows,
       count(DISTINCT o_orderpriority) AS n_leagues FROM orders GROUP BY 1""")
def yearly_scan_counts(spark, d):
    o = B.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("gameid"),
        F.col("o_orderpriority").alias("league"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.year("o_orderdate").alias("year"))
    root = files.write_yearly_csv(o, files.stage_path(spark, "yearly"), "year")
    df = files.load_yearly(spark, root, YEARS, pattern="year={year}",
                           required=["gameid", "league", "date"])
    return df.groupBy("_source_year").agg(F.count("*").alias("n_rows"),
                                           F.countDistinct("league").alias("n_leagues"))


@query("stage_roundtrip", sql_finish(W("SELECT * FROM f", *flows.FEATURE_CTES), flows.F_DOUBLES))
def stage_roundtrip(spark, d):
    table = flows.feature_table(spark, d)
    path = files.write_stage(table, files.stage_path(spark, "features"))
    back = files.read_stage(spark, path)
    return finish(back.select(*table.columns))


@query("stage_replace", """
SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS _source_year,
       CASE WHEN year(o_orderdate) = 1996 THEN 'corrected' END AS note
FROM orders WHERE year(o_orderdate) <> 1996 OR o_orderpriority = '1-URGENT'""")
def stage_replace(spark, d):
    """A table of all years, then one year written anew with a further column."""
    o = B.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("_source_year"))
    path = files.stage_path(spark, "orders")
    files.replace_partitions(o, path)
    files.replace_partitions(o.where("_source_year = 1996 AND o_orderpriority = '1-URGENT'")
                             .withColumn("note", F.lit("corrected")), path)
    return files.read_partitions(spark, path)


@query("elbow_documents", """
WITH s AS (SELECT c_mktsegment AS position, c_nationkey % 9 + 2 AS k, min(c_acctbal)::DOUBLE AS inertia,
                  max(c_acctbal)::DOUBLE AS silhouette FROM customer GROUP BY ALL),
b AS (SELECT position, arg_max(k, (silhouette, -k)) AS best_k FROM s GROUP BY 1)
SELECT position, CAST(k AS INTEGER) AS k, inertia, silhouette, k = best_k AS is_best FROM s JOIN b USING (position)""")
def elbow_documents(spark, d):
    """Sweep rows per (position, k) nested into one document per position, written as JSON, and the
    elbow table built from the stored documents."""
    s = B.table(spark, d, "customer").groupBy(
        F.col("c_mktsegment").alias("position"), (F.col("c_nationkey") % 9 + 2).cast("int").alias("k")).agg(
        F.min("c_acctbal").cast("double").alias("inertia"), F.max("c_acctbal").cast("double").alias("silhouette"))
    best = s.groupBy("position").agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("best"))
    s = s.join(best, "position").withColumn("is_best", F.col("k") == F.col("best"))
    path = files.write_json(files.sweep_documents(s), files.stage_path(spark, "sweep"))
    return files.read_sweep(spark, path)


@query("json_roundtrip", W("""
SELECT league, position, count(*) AS n FROM m GROUP BY league, position""", ("m", B.M_SQL)))
def json_roundtrip(spark, d):
    m = B.match(spark, d)
    nested = m.groupBy("league", "position").agg(F.count("*").alias("n")) \
        .groupBy("league").agg(F.collect_list(F.struct("position", "n")).alias("by_position"))
    path = files.write_json(nested, files.stage_path(spark, "counts_json"))
    back = files.read_json(spark, path, "league string, by_position array<struct<position:string,n:bigint>>")
    return back.select("league", F.inline("by_position"))


@query("json_profiles_explode", sql_finish(W(
    "SELECT position, cluster, n_players, n_promoted, promo_rate, archetype FROM prof",
    ("v", B.V_SQL), VC, PROF_SQL), ["promo_rate"]))
def json_profiles_explode(spark, d):
    v = B.vectors(spark, d).withColumn("cluster", (F.col("row_id") % 3).cast("int"))
    prof = stats.cluster_profiles(v, "position", "cluster", "promoted_to_lec")
    path = files.write_json(files.profiles_document(prof), files.stage_path(spark, "profiles"),
                            single_file=True)
    return finish(files.read_profiles(spark, path))


PAIRS = [("BUILDING", 1996), ("MACHINERY", 1998), ("NOPE", 1999)]


@query("appearance_extract", """
SELECT l.l_suppkey AS player, l.l_orderkey AS game, c.c_mktsegment AS league,
       CAST(year(o.o_orderdate) AS INTEGER) AS year
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE (c.c_mktsegment = 'BUILDING' AND year(o.o_orderdate) = 1996)
   OR (c.c_mktsegment = 'MACHINERY' AND year(o.o_orderdate) = 1998)
   OR (c.c_mktsegment = 'NOPE' AND year(o.o_orderdate) = 1999)""")
def appearance_extract(spark, d):
    return appearances.appearances(
        B.table(spark, d, "lineitem"), B.table(spark, d, "orders"), B.table(spark, d, "customer"),
        PAIRS, line_game="l_orderkey", line_player="l_suppkey", game_id="o_orderkey",
        game_tournament="o_custkey", game_date="o_orderdate", tournament_id="c_custkey",
        tournament_league="c_mktsegment").select("player", "game", "league", "year")


@query("appearance_detail", """
SELECT l.l_suppkey AS player, l.l_orderkey AS game, c.c_mktsegment AS league,
       CAST(year(o.o_orderdate) AS INTEGER) AS year, strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
       l.l_returnflag AS team, l.l_linestatus AS role, l.l_partkey AS champion
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'MACHINERY' AND year(o.o_orderdate) = 1998""")
def appearance_detail(spark, d):
    out = appearances.appearances(
        B.table(spark, d, "lineitem"), B.table(spark, d, "orders"), B.table(spark, d, "customer"),
        PAIRS[1:2], line_game="l_orderkey", line_player="l_suppkey", game_id="o_orderkey",
        game_tournament="o_custkey", game_date="o_orderdate", tournament_id="c_custkey",
        tournament_league="c_mktsegment",
        line_more={"team": "l_returnflag", "role": "l_linestatus", "champion": "l_partkey"})
    return finish(out.withColumn("date", F.col("date").cast("timestamp")))


@query("roster_extract", """
SELECT DISTINCT o.o_orderpriority AS league, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       l.l_returnflag AS team, l.l_suppkey AS player, l.l_linestatus AS role
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE (o.o_orderpriority = '1-URGENT' AND year(o.o_orderdate) = 1996)
   OR (o.o_orderpriority = '2-HIGH' AND year(o.o_orderdate) = 1997)""")
def roster_extract(spark, d):
    return appearances.rosters(
        B.table(spark, d, "lineitem"), B.table(spark, d, "orders"), [("1-URGENT", 1996), ("2-HIGH", 1997)],
        entry_tournament="l_orderkey", entry_player="l_suppkey", entry_team="l_returnflag",
        entry_role="l_linestatus", tournament_id="o_orderkey", tournament_league="o_orderpriority",
        tournament_date="o_orderdate")


@query("json_documents", W("""
SELECT 'career' AS document, CAST(playername AS VARCHAR) AS key, CAST(_source_year AS VARCHAR) AS item,
       list_aggregate(list_sort(list(DISTINCT league)), 'string_agg', ',') AS value FROM c GROUP BY playername, _source_year
UNION ALL SELECT 'metric', league, 'rows', CAST(count(*) AS VARCHAR) FROM c GROUP BY league
UNION ALL SELECT 'freshness', strftime(max(date), '%Y-%m-%d'), CAST(count(DISTINCT playername) AS VARCHAR),
       CAST(count(*) AS VARCHAR) FROM c
UNION ALL SELECT 'k_score', league, CAST(_source_year AS VARCHAR), CAST(count(*) AS VARCHAR) FROM c
  GROUP BY league, _source_year""", ("c", B.C_SQL)))
def json_documents(spark, d):
    """Careers, metrics, freshness and k scores written as JSON and read back."""
    c = B.career(spark, d)

    def back(df, name, read):
        return read(spark, files.write_json(df, files.stage_path(spark, name)))

    per = c.groupBy("playername", "_source_year").agg(F.collect_list("league").alias("l"))
    career = per.groupBy(F.col("playername").cast("string").alias("player")).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("_source_year").cast("string"), "l"))).alias("career"))
    metric = c.groupBy("league").agg(F.count("*").cast("double").alias("n"))
    metric = metric.agg(F.map_from_entries(F.collect_list(F.struct(
        "league", F.create_map(F.lit("rows"), "n")))).alias("models"))
    fresh = c.agg(F.date_format(F.max("date"), "yyyy-MM-dd").alias("data_max_date"), F.count("*").alias("n_rows"),
                  F.array_sort(F.collect_set("_source_year")).alias("data_years"),
                  F.countDistinct("playername").alias("n_players"))
    scores = c.groupBy(F.col("league").alias("position"), F.col("_source_year").alias("k")).agg(
        F.count("*").cast("double").alias("inertia"))
    text = lambda c: F.col(c).cast("string")
    whole = lambda c: F.col(c).cast("long").cast("string")
    rows = [
        back(career, "careers", files.read_careers).select(
            F.lit("career").alias("document"), F.col("player").alias("key"), text("year").alias("item"),
            F.array_join("leagues", ",").alias("value")),
        back(metric, "metrics", files.read_metrics).select(F.lit("metric"), "model", "metric", whole("value")),
        back(fresh, "freshness", files.read_freshness).select(
            F.lit("freshness"), "data_max_date", text("n_players"), text("n_rows")),
        back(scores, "k_scores", files.read_k_scores).select(F.lit("k_score"), "position", text("k"), whole("inertia"))]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])
