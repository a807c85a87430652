"""Bindings of the generic operators onto the driver's test tables.

Each binding exists twice: as a Spark DataFrame builder and as a DuckDB CTE body
over the pre-registered views, written from the same definition, so
``oracle_sql`` can run the same query on the same rows. NULLs are injected
deterministically (same expression on both sides) because the test tables have
none.

* **M** match rows  : lineitem ⋈ orders
* **C** career rows : orders (player = customer)
* **S** score rows  : events (player = user, position = league = event type)
* **K** cluster rows: one row per (user, event type, year, split) of events
* **D** supervised  : documents ⋈ labels
* **V** vectors     : embeddings, every dimension as a feature (``wide_vectors``); the
  operators that name the nine clustering features read them from nine dimensions
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C

CAREER_TOP = "1-URGENT"
CAREER_FEEDERS = ("2-HIGH", "3-MEDIUM")
MATCH_ROLES = C.Roles(feeders=CAREER_FEEDERS, top=CAREER_TOP)
MATCH_KEYS = ["playername", "league", "_source_year", "position"]
MATCH_PEERS = ["league", "_source_year", "position"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as scanned: columns and filters of the query reach the file."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- M ----------------------------------------------------------------------------

def match(spark: SparkSession, sf_dir: str) -> DataFrame:
    l_ = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = l_.join(o, l_["l_orderkey"] == o["o_orderkey"])
    return j.select(
        F.col("l_orderkey").alias("gameid"),
        F.col("o_orderpriority").alias("league"),
        F.year("o_orderdate").alias("_source_year"),
        F.when(F.month("o_orderdate") <= 6, "Spring").otherwise("Summer").alias("split"),
        F.col("o_orderdate").alias("date"),
        F.col("l_linestatus").alias("position"),
        F.concat(F.lit("  S"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("playername"),
        F.col("l_returnflag").alias("teamname"),
        F.col("l_partkey").alias("champion"),
        (F.col("l_discount") > F.lit(0.05)).cast("int").alias("result"),
        F.col("l_quantity").alias("kills"),
        F.col("l_linenumber").cast("double").alias("assists"),
        F.col("l_extendedprice").alias("dpm"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 20 == 0, F.lit(None))
        .otherwise(F.col("l_discount") * 100).cast("double").alias("vspm"),
    )


M_SQL = """
SELECT l.l_orderkey AS gameid, o.o_orderpriority AS league,
       CAST(year(o.o_orderdate) AS INTEGER) AS _source_year,
       CASE WHEN month(o.o_orderdate) <= 6 THEN 'Spring' ELSE 'Summer' END AS split,
       o.o_orderdate AS date, l.l_linestatus AS position,
       '  S' || CAST(l.l_suppkey AS VARCHAR) || ' ' AS playername,
       l.l_returnflag AS teamname, l.l_partkey AS champion,
       CAST(l.l_discount > 0.05 AS INTEGER) AS result,
       l.l_quantity AS kills, CAST(l.l_linenumber AS DOUBLE) AS assists,
       l.l_extendedprice AS dpm,
       CAST(CASE WHEN (l.l_orderkey + l.l_linenumber) % 20 = 0 THEN NULL
            ELSE l.l_discount * 100 END AS DOUBLE) AS vspm
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

# normalised names (P-C5) on top of M
MN_SQL = """
SELECT * EXCLUDE (playername), playername AS playername_original,
       lower(trim(playername)) AS playername
FROM m
"""

# --- C ----------------------------------------------------------------------------

def career(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("gameid"),
        F.col("o_custkey").alias("playername"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("league"),
        F.year("o_orderdate").alias("_source_year"),
    )


C_SQL = """
SELECT o_orderkey AS gameid, o_custkey AS playername, o_orderdate AS date,
       o_orderpriority AS league, CAST(year(o_orderdate) AS INTEGER) AS _source_year
FROM orders
"""

# --- S ----------------------------------------------------------------------------

def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("playername"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("playername_original"),
        F.col("event_type").alias("position"),
        F.col("event_type").alias("league"),
        F.year("ts").alias("_source_year"),
        F.when(F.dayofmonth("ts") <= 15, "Spring").otherwise("Summer").alias("split"),
        F.concat(F.lit("T"), (F.col("user_id") % 4).cast("string")).alias("teamname"),
        F.col("ts").alias("date"),
        F.col("value").alias("talent_score"),
        ((F.col("event_id") % 7) == 0).alias("promoted_to_lec"),
        (F.col("value") / 50).alias("win_rate"),
        (F.col("event_id") % 30 + 5).alias("games_played"),
    )


S_SQL = """
SELECT event_id AS row_id, user_id AS playername,
       'P' || CAST(user_id AS VARCHAR) AS playername_original,
       event_type AS position, event_type AS league,
       CAST(year(ts) AS INTEGER) AS _source_year,
       CASE WHEN day(ts) <= 15 THEN 'Spring' ELSE 'Summer' END AS split,
       'T' || CAST(user_id % 4 AS VARCHAR) AS teamname, ts AS date,
       value AS talent_score, (event_id % 7) = 0 AS promoted_to_lec,
       value / 50 AS win_rate, event_id % 30 + 5 AS games_played
FROM events
"""

# --- K ----------------------------------------------------------------------------

def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scores(spark, sf_dir)
    k = s.select("playername", "position", "_source_year", "split", "league", "teamname") \
        .distinct()
    cl = ((F.col("playername") + F.length("position")) % 3).cast("int")
    return k.select(
        "playername", "position", "_source_year", "split", "league", "teamname",
        cl.alias("cluster"),
        F.when(F.col("playername") % 5 == 0, F.lit(None).cast("string"))
        .when(cl == 0, F.lit("Carry agressif"))
        .when(cl == 1, F.lit("Vision controller"))
        .otherwise(F.lit("Profil neutre")).alias("archetype"),
    )


K_SQL = """
SELECT playername, position, _source_year, split, league, teamname,
       CAST((playername + length(position)) % 3 AS INTEGER) AS cluster,
       CASE WHEN playername % 5 = 0 THEN NULL
            WHEN (playername + length(position)) % 3 = 0 THEN 'Carry agressif'
            WHEN (playername + length(position)) % 3 = 1 THEN 'Vision controller'
            ELSE 'Profil neutre' END AS archetype
FROM (SELECT DISTINCT playername, position, _source_year, split, league, teamname FROM s)
"""


def profiles_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(position, cluster) -> archetype, from the stored cluster labels of K."""
    k = clusters(spark, sf_dir).where(F.col("archetype").isNotNull())
    return k.select(F.lower("position").alias("position"), "cluster", "archetype").distinct()


PROFILES_SQL = """
SELECT DISTINCT lower(position) AS position, cluster, archetype FROM k WHERE archetype IS NOT NULL
"""

# --- D ----------------------------------------------------------------------------

def supervised(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """Labelled documents; ``how="left"``: every document, the labels NULL where there are none, with
    ``labelled``: whether there is a row of labels."""
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    # the texts' figures come first, so that no text is joined or shuffled; runs of other characters are taken out at once
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars", words.alias("words"),
        F.length(F.regexp_replace("text", r"[^0-9]+", "")).alias("digits"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).alias("upper"))
    lb = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    j = d.join(lb, "doc_id", how)
    return j.select(
        F.col("doc_id").alias("row_id"),
        F.col("source").alias("group"),
        F.col("lang").alias("position"),
        F.col("toxic").alias("y"),
        F.col("quality").alias("quality"),
        F.col("n_chars").cast("double").alias("score"),
        F.col("n_chars").cast("double").alias("f_chars"),
        F.col("words").cast("double").alias("f_words"),
        (F.col("n_chars") / F.greatest("words", F.lit(1))).cast("double").alias("f_word_len"),
        F.col("digits").cast("double").alias("f_digits"),
        F.col("upper").cast("double").alias("f_upper"),
        *([F.coalesce("labelled", F.lit(False)).alias("labelled")] if how == "left" else []),
    )


D_FEATURES = ["f_chars", "f_words", "f_word_len", "f_digits", "f_upper"]

D_ALL_SQL = """
SELECT d.doc_id AS row_id, d.lang AS position, l.toxic AS y FROM documents d LEFT JOIN labels l USING (doc_id)
"""

D_SQL = """
SELECT d.doc_id AS row_id, d.source AS "group", d.lang AS position, l.toxic AS y,
       l.quality AS quality, CAST(d.n_chars AS DOUBLE) AS score,
       CAST(d.n_chars AS DOUBLE) AS f_chars,
       CAST(len(string_split_regex(trim(d.text), '\\s+')) AS DOUBLE) AS f_words,
       CAST(d.n_chars / greatest(len(string_split_regex(trim(d.text), '\\s+')), 1) AS DOUBLE) AS f_word_len,
       CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS DOUBLE) AS f_digits,
       CAST(length(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS DOUBLE) AS f_upper
FROM documents d JOIN labels l USING (doc_id)
"""

# --- V ----------------------------------------------------------------------------

def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("playername"),
        F.col("label").cast("string").alias("position"),
        ((F.col("vec_id") % 11) == 0).alias("promoted_to_lec"),
        *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(C.CLUSTER_FEATURES)],
    )


V_SQL = "SELECT vec_id AS row_id, 'v' || CAST(vec_id AS VARCHAR) AS playername, " \
        "CAST(label AS VARCHAR) AS position, (vec_id % 11) = 0 AS promoted_to_lec, " + ", ".join(
            f"CAST(embedding[{i + 1}] AS DOUBLE) AS {f}" for i, f in enumerate(C.CLUSTER_FEATURES)
        ) + " FROM embeddings"


WIDTH = 64                                    # dimensions of the embeddings
WIDE = [f"x{i}" for i in range(WIDTH)]


def wide_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V with every dimension as a feature."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row_id"),
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("playername"),
        F.col("label").cast("string").alias("position"),
        ((F.col("vec_id") % 11) == 0).alias("promoted_to_lec"),
        *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(WIDE)])


WIDE_SQL = "SELECT vec_id AS row_id, 'v' || CAST(vec_id AS VARCHAR) AS playername, " \
           "CAST(label AS VARCHAR) AS position, (vec_id % 11) = 0 AS promoted_to_lec, " + ", ".join(
               f"CAST(embedding[{i + 1}] AS DOUBLE) AS {f}" for i, f in enumerate(WIDE)) + " FROM embeddings"


def with_ctes(body: str, *ctes: tuple[str, str]) -> str:
    """``WITH a AS (...), b AS (...) <body>``."""
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body
