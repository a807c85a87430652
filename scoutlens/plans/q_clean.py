"""Queries: schema checks, cleaning, dated target, career labels, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, quality, setops, target
from . import bindings as B
from . import flows
from .catalog import finish, query, sql_finish

W = B.with_ctes
M = ("m", B.M_SQL)
CC = ("c", B.C_SQL)
R = B.MATCH_ROLES
CR = B.MATCH_ROLES  # career rows use the same league roles


# --- Q-B -----------------------------------------------------------------------------

LINEITEM_WANTED = ["l_orderkey", "l_quantity", "l_missing_a", "l_tax", "l_missing_b"]


@query("schema_missing_columns", """
SELECT * FROM (VALUES ('l_orderkey', 'required', true), ('l_quantity', 'required', true),
  ('l_missing_a', 'required', false), ('l_tax', 'required', true), ('l_missing_b', 'optional', false))
  t("column", kind, present)
LEFT JOIN (SELECT 'l_orderkey' AS "column", CAST(count(l_orderkey) AS DOUBLE) AS non_null FROM lineitem UNION ALL
           SELECT 'l_quantity', count(l_quantity) FROM lineitem UNION ALL
           SELECT 'l_tax', count(l_tax) FROM lineitem) c USING ("column")""")
def schema_missing_columns(spark, d):
    li = B.table(spark, d, "lineitem")
    out = quality.missing_columns_report(li, LINEITEM_WANTED[:3] + ["l_tax"], ["l_missing_b"])
    # nullable integer column emitted as double (identical in both engines' frames)
    return out.withColumn("non_null", F.col("non_null").cast("double"))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


@query("schema_numeric_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if(CAST({c} AS VARCHAR) IS NOT NULL AND "
    f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL) AS BIGINT) AS n_bad FROM orders"
    for c in ORDER_COLS) + ")")
def schema_numeric_report(spark, d):
    o = B.table(spark, d, "orders")
    o = o.select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLS])
    return quality.check_numeric(o, ORDER_COLS)


VALIDATION_SQL = W("""
SELECT * FROM (
 SELECT 'non_empty' AS "check", CAST(n_rows AS VARCHAR) AS value, n_rows > 0 AS ok FROM a UNION ALL
 SELECT 'players', CAST(n_players AS VARCHAR), n_players >= 10 FROM a UNION ALL
 SELECT 'feeder_div1_present', div1, true FROM a UNION ALL
 SELECT 'top_league_present', CAST(n_top AS VARCHAR), n_top > 0 FROM a UNION ALL
 SELECT 'positions', positions, true FROM a UNION ALL
 SELECT 'target_rows', CAST(n_target AS VARCHAR), true FROM a UNION ALL
 SELECT 'target_rate_pct', CAST(round(n_target * 100.0 / n_rows, 2) AS VARCHAR), true FROM a UNION ALL
 SELECT 'nulls_playername', CAST(np AS VARCHAR), np = 0 FROM a UNION ALL
 SELECT 'nulls_teamname', CAST(nt AS VARCHAR), nt = 0 FROM a UNION ALL
 SELECT 'nulls_league', CAST(nl AS VARCHAR), nl = 0 FROM a UNION ALL
 SELECT 'nulls_position', CAST(npos AS VARCHAR), npos = 0 FROM a UNION ALL
 SELECT 'all_ok', NULL, n_rows > 0 AND n_players >= 10 AND np + nt + nl + npos = 0 FROM a)
""", M, ("mn", B.MN_SQL), ("mt", flows.MT_SQL), ("a", """
SELECT count(*) AS n_rows, count(DISTINCT playername) AS n_players,
  array_to_string(list_sort(list_distinct(list(league) FILTER (WHERE league IN ('2-HIGH')))), ',') AS div1,
  CAST(count_if(league = '1-URGENT') AS BIGINT) AS n_top,
  array_to_string(list_sort(list_distinct(list(position))), ',') AS positions,
  CAST(count_if(promoted_to_lec) AS BIGINT) AS n_target, CAST(count_if(playername IS NULL) AS BIGINT) AS np,
  CAST(count_if(teamname IS NULL) AS BIGINT) AS nt, CAST(count_if(league IS NULL) AS BIGINT) AS nl, CAST(count_if(position IS NULL) AS BIGINT) AS npos
FROM mt"""))


@query("validation_report", VALIDATION_SQL)
def validation_report(spark, d):
    return quality.validate(flows.clean_match(spark, d), R, div1=["2-HIGH"])


@query("freshness_metadata", W(
    "SELECT strftime(max(CAST(date AS DATE)), '%Y-%m-%d') AS data_max_date, "
    "array_to_string(list_sort(list_distinct(list(_source_year))), ',') AS data_years, "
    "count(*) AS n_rows, count(DISTINCT playername) AS n_players FROM m", M))
def freshness_metadata(spark, d):
    f = quality.freshness(B.match(spark, d), R)
    return f.withColumn("data_years", F.array_join("data_years", ","))


NULLM = ("mx", """SELECT *, CASE WHEN gameid % 13 = 0 THEN NULL ELSE teamname END AS team2,
  CASE WHEN gameid % 17 = 0 THEN NULL ELSE playername END AS player2 FROM m""")


def _null_match(spark, d):
    m = B.match(spark, d)
    return m.withColumn("team2", F.when(F.col("gameid") % 13 == 0, None).otherwise(F.col("teamname"))) \
        .withColumn("player2", F.when(F.col("gameid") % 17 == 0, None).otherwise(F.col("playername")))


@query("null_census", W("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS non_null, count(*) - count({c}) AS nulls FROM mx"
    for c in ["gameid", "league", "_source_year", "split", "date", "position", "playername",
              "teamname", "champion", "result", "kills", "assists", "dpm", "vspm", "team2",
              "player2"]) + ")", M, NULLM))
def null_census(spark, d):
    return quality.null_census(_null_match(spark, d)).drop("type")


# --- P-C -----------------------------------------------------------------------------

@query("league_discovery", W("""
SELECT league, count(*) AS n_rows,
  CASE WHEN league IN ('2-HIGH') THEN 'div1' WHEN league IN ('3-MEDIUM') THEN 'div2'
       WHEN league = '1-URGENT' THEN 'top' ELSE 'other' END AS tier
FROM m WHERE league IS NOT NULL GROUP BY league""", M))
def league_discovery(spark, d):
    return clean.discover(B.match(spark, d), "league", ["2-HIGH"], ["3-MEDIUM"], "1-URGENT")


@query("league_filter_partial", W("""
SELECT gameid, position, playername, league FROM m
WHERE league IN ('1-URGENT')
   OR league = (SELECT min(league) FROM (SELECT DISTINCT league FROM m WHERE league IS NOT NULL)
                WHERE contains(lower(league), 'high') OR contains('high', lower(league)))
   OR league = (SELECT min(league) FROM (SELECT DISTINCT league FROM m WHERE league IS NOT NULL)
                WHERE contains(lower(league), 'nope') OR contains('nope', lower(league)))""", M))
def league_filter_partial(spark, d):
    out = clean.filter_targets(B.match(spark, d), ["1-URGENT", "high", "nope"], "league")
    return out.select("gameid", "position", "playername", "league")


EV_MIXED = ("ev", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(event_type) "
                  "ELSE event_type END AS position FROM events")


@query("role_filter", W("SELECT event_id, position FROM ev "
                        "WHERE lower(position) IN ('click', 'view', 'purchase')", EV_MIXED))
def role_filter(spark, d):
    e = B.table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.upper("event_type"))
        .otherwise(F.col("event_type")).alias("position"))
    return clean.filter_roles(e, "position", ["click", "view", "purchase"])


@query("column_selection", sql_finish(
    "SELECT l_orderkey, l_quantity, l_tax, l_linenumber FROM lineitem", ["l_quantity", "l_tax"]))
def column_selection(spark, d):
    li = B.table(spark, d, "lineitem")
    out, _missing = clean.select_known(li, LINEITEM_WANTED, extra=("l_linenumber",))
    return finish(out)


@query("name_normalization", W(
    "SELECT gameid, assists, playername, playername_original FROM mn", M, ("mn", B.MN_SQL)))
def name_normalization(spark, d):
    m = clean.normalize_name(B.match(spark, d))
    return finish(m.select("gameid", "assists", "playername", "playername_original"))


@query("drop_missing_identity", sql_finish(W(
    "SELECT gameid, assists, player2, team2, league FROM mx "
    "WHERE player2 IS NOT NULL AND team2 IS NOT NULL AND league IS NOT NULL", M, NULLM),
    ["assists"]))
def drop_missing_identity(spark, d):
    m = _null_match(spark, d)
    out = clean.drop_missing(m, ["player2", "team2", "league"])
    return finish(out.select("gameid", "assists", "player2", "team2", "league"))


IMPUTE_SQL = W("""
SELECT gameid, assists, coalesce(v, (SELECT median(v) FROM g)) AS vspm FROM g""", M,
               ("m2", "SELECT *, CASE WHEN league = '5-LOW' AND _source_year = 1996 THEN NULL "
                      "ELSE vspm END AS v FROM m"),
               ("g", "SELECT gameid, assists, coalesce(v, median(v) OVER "
                     "(PARTITION BY league, _source_year)) AS v FROM m2"))


@query("impute_group_median", sql_finish(IMPUTE_SQL, ["assists", "vspm"]))
def impute_group_median(spark, d):
    m = B.match(spark, d)
    m = m.withColumn("vspm", F.when((F.col("league") == "5-LOW") & (F.col("_source_year") == 1996),
                                    None).otherwise(F.col("vspm")))
    # the operator reads its input several times: give it a staged table
    out = clean.impute_group_median(flows.stage(m), keys=("league", "_source_year"))
    return finish(out.select("gameid", "assists", "vspm"))


@query("fill_unknown", sql_finish(W(
    "SELECT gameid, assists, coalesce(team2, 'unknown') AS team2, "
    "coalesce(player2, 'unknown') AS player2 FROM mx", M, NULLM), ["assists"]))
def fill_unknown(spark, d):
    m = _null_match(spark, d).select("gameid", "assists", "team2", "player2")
    return finish(clean.fill_unknown(m))


# --- D-2/3, G-A4/5/7/8, D-7 ------------------------------------------------------------

DEB = ("deb", "SELECT playername, min(date) AS debut FROM c WHERE league = '1-URGENT' "
              "AND date IS NOT NULL GROUP BY playername")
CT = ("ct", """SELECT c.*, deb.debut, coalesce(c.league IN ('2-HIGH', '3-MEDIUM')
   AND deb.debut IS NOT NULL AND c.date IS NOT NULL AND deb.debut > c.date
   AND deb.debut <= c.date + INTERVAL 18 MONTH, false) AS promoted_to_lec
   FROM c LEFT JOIN deb USING (playername)""")


def _career_target(spark, d):
    return target.dated_target(B.career(spark, d), roles=CR, keep_debut=True)


@query("debut_dates", sql_finish(W("SELECT * FROM deb", CC, DEB), stamps=["debut"]))
def debut_dates(spark, d):
    return finish(target.debut_dates(B.career(spark, d), CR))


@query("debut_lookup", sql_finish(W(
    "SELECT c.gameid, c.playername, deb.debut FROM c LEFT JOIN deb USING (playername)", CC, DEB),
    stamps=["debut"]))
def debut_lookup(spark, d):
    c = B.career(spark, d)
    out = target.attach_lookup(c, target.debut_dates(c, CR), "playername")
    return finish(out.select("gameid", "playername", "debut"))


@query("dated_target", sql_finish(W(
    "SELECT gameid, playername, league, date, promoted_to_lec FROM ct", CC, DEB, CT),
    stamps=["date"]))
def dated_target(spark, d):
    out = _career_target(spark, d)
    return finish(out.select("gameid", "playername", "league", "date", "promoted_to_lec"))


@query("target_summary", W("""
SELECT CAST(count_if(promoted_to_lec) AS BIGINT) AS positive_rows,
       count(DISTINCT CASE WHEN promoted_to_lec THEN playername END) AS positive_players,
       count(DISTINCT CASE WHEN league IN ('2-HIGH', '3-MEDIUM') THEN playername END) AS feeder_players,
       CAST(count_if(league IN ('2-HIGH', '3-MEDIUM')) AS BIGINT) AS feeder_rows FROM ct""", CC, DEB, CT))
def target_summary(spark, d):
    return target.target_summary(_career_target(spark, d), CR)


@query("career_map", W("""
SELECT CAST(playername AS VARCHAR) AS playername, CAST(_source_year AS VARCHAR) AS _source_year,
       array_to_string(list_sort(list_distinct(list(trim(league)))), ',') AS leagues
FROM c WHERE playername IS NOT NULL AND league IS NOT NULL AND trim(league) <> ''
GROUP BY ALL""", CC))
def career_map(spark, d):
    cm = target.career_map(B.career(spark, d), "playername", "_source_year", "league")
    return cm.withColumn("leagues", F.array_join("leagues", ","))


PROMO = ("pl", """SELECT playername, coalesce(max(CASE WHEN league = '1-URGENT' THEN _source_year END)
  >= min(CASE WHEN league IN ('2-HIGH', '3-MEDIUM') THEN _source_year END), false) AS promoted
  FROM c GROUP BY playername""")


def _promotion(spark, d):
    return target.promotion_label(B.career(spark, d), "playername", "_source_year", "league",
                                  "1-URGENT", ["2-HIGH", "3-MEDIUM"])


@query("promotion_label", W("SELECT * FROM pl", CC, PROMO))
def promotion_label(spark, d):
    return _promotion(spark, d)


@query("label_cross_check", W("""
SELECT count(*) AS declared, CAST(count_if(b.playername IS NOT NULL) AS BIGINT) AS confirmed,
       CAST(count_if(b.playername IS NULL) AS BIGINT) AS undatable
FROM (SELECT DISTINCT playername FROM pl WHERE promoted) a
LEFT JOIN (SELECT DISTINCT playername FROM ct WHERE promoted_to_lec) b USING (playername)""",
       CC, DEB, CT, PROMO))
def label_cross_check(spark, d):
    declared = _promotion(spark, d).where("promoted")
    dated = _career_target(spark, d).where("promoted_to_lec")
    return target.cross_check(declared, dated, "playername")


@query("class_balance", W("""
SELECT count(*) AS n_rows, CAST(count_if(promoted_to_lec) AS BIGINT) AS n_pos_rows,
  round(CAST(count_if(promoted_to_lec) AS BIGINT) * 100.0 / count(*), 6) AS pos_rate_rows,
  (SELECT count(*) FROM ent) AS n_entities, (SELECT CAST(count_if(y) AS BIGINT) FROM ent) AS n_pos_entities,
  (SELECT (count(*) - CAST(count_if(y) AS BIGINT)) // greatest(CAST(count_if(y) AS BIGINT), 1) FROM ent) AS neg_per_pos
FROM ft""", CC, DEB, CT,
    ("ft", "SELECT * FROM ct WHERE league IN ('2-HIGH', '3-MEDIUM')"),
    ("ent", "SELECT playername, bool_or(promoted_to_lec) AS y FROM ft GROUP BY playername")))
def class_balance(spark, d):
    from ..operators import stats
    ft = _career_target(spark, d).where(F.col("league").isin("2-HIGH", "3-MEDIUM"))
    return finish(stats.class_balance(ft, "playername", "promoted_to_lec"))


@query("promoted_by_league", W("""
SELECT league, count(DISTINCT playername) AS n_promoted FROM ct
WHERE league IN ('2-HIGH', '3-MEDIUM') AND promoted_to_lec GROUP BY league""", CC, DEB, CT))
def promoted_by_league(spark, d):
    from ..operators import stats
    ft = _career_target(spark, d).where(F.col("league").isin("2-HIGH", "3-MEDIUM"))
    return stats.promoted_by(ft, "league", "playername", "promoted_to_lec")


# --- U -------------------------------------------------------------------------------

@query("union_aligned", sql_finish("""
SELECT o_custkey AS custkey, o_orderkey, NULL::INTEGER AS c_nationkey, o_totalprice AS amount FROM orders
UNION ALL
SELECT c_custkey AS custkey, NULL::BIGINT AS o_orderkey, c_nationkey, c_acctbal AS amount FROM customer""",
                                    ["amount", "o_orderkey", "c_nationkey"]))
def union_aligned(spark, d):
    o = B.table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey",
                                           F.col("o_totalprice").alias("amount"))
    c = B.table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_nationkey",
                                             F.col("c_acctbal").alias("amount"))
    out = setops.union_aligned(o, c)
    # nullable integer columns are emitted as doubles (identical in both engines' frames)
    return finish(out.withColumn("o_orderkey", F.col("o_orderkey").cast("double"))
                  .withColumn("c_nationkey", F.col("c_nationkey").cast("double")))


@query("distinct_rows", W("SELECT DISTINCT playername, position FROM s", ("s", B.S_SQL)))
def distinct_rows(spark, d):
    return setops.distinct_rows(B.scores(spark, d), ["playername", "position"])


@query("set_intersect_except", W("""
SELECT 'both' AS kind, playername FROM (SELECT DISTINCT playername FROM c
   WHERE league IN ('2-HIGH', '3-MEDIUM') INTERSECT SELECT playername FROM deb)
UNION ALL
SELECT 'a_only', playername FROM (SELECT DISTINCT playername FROM c
   WHERE league IN ('2-HIGH', '3-MEDIUM') EXCEPT SELECT playername FROM deb)""", CC, DEB))
def set_intersect_except(spark, d):
    c = B.career(spark, d)
    a = c.where(F.col("league").isin("2-HIGH", "3-MEDIUM"))
    return setops.set_ops(a, target.debut_dates(c, CR), "playername")
