"""File sinks and sources of whole tables and documents (S-A2 … S-A5).

* stage tables are written as parquet partitioned by ``_source_year`` (year
  filters then prune files) and read back with booleans repaired when the
  source is text; :mod:`.stage_table` replaces single partitions, :mod:`.yearly`
  reads the yearly exports;
* nested results (metrics, profiles, sweeps, careers) go through Spark's JSON
  writer/reader with a declared schema.

Scratch and stage folders live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text_bool
from ..operators.quality import SchemaValidationError  # noqa: F401
from ..session import materialize, stage_path  # noqa: F401
from .stage_table import read_partitions, replace_partitions  # noqa: F401
from .yearly import load_yearly  # noqa: F401


def write_yearly_csv(df: DataFrame, root: str, year_col: str) -> str:
    """Write one CSV folder per year in a single job: ``{root}/{year_col}={year}/``."""
    (df.write.mode("overwrite").partitionBy(year_col).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(root))
    return root


def repair_booleans(df: DataFrame, cols: list[str]) -> DataFrame:
    """S-A2 helper: text booleans -> ``lower(trim(x)) == 'true'`` (numeric 1 also true)."""
    for c in cols:
        if c in df.columns and not isinstance(df.schema[c].dataType, T.BooleanType):
            df = df.withColumn(c, text_bool(c))
    return df


def read_stage(spark: SparkSession, path: str, bool_cols=("promoted_to_lec",),
               fmt: str = "parquet") -> DataFrame:
    """S-A2: typed re-read of a stage table (parquet keeps types; CSV is repaired)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return repair_booleans(df, list(bool_cols))


def write_stage(df: DataFrame, path: str, partition_by=("_source_year",),
                fmt: str = "parquet") -> str:
    """S-A3: stage-table sink, partitioned by year when the column exists."""
    parts = [c for c in partition_by if c in df.columns]
    w = df.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "parquet":
        w.parquet(path)
    else:
        (w.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_json(df: DataFrame, path: str, single_file: bool = False) -> str:
    """S-A4: JSON sink of nested results (one JSON object per row)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S-A5: JSON source with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


PROFILE_STRUCT = ("struct<cluster:int,n_players:bigint,n_promoted:bigint,promo_rate:double,"
                  "archetype:string>")


def profiles_document(profiles: DataFrame, part: str = "position") -> DataFrame:
    """Nest profiles as one document ``map<position, array<struct>>``.

    The profile table has one row per (position, cluster) — bounded by
    positions x k — so collecting it into one row is safe.
    """
    per = profiles.groupBy(part).agg(F.array_sort(F.collect_list(F.struct(
        "cluster", "n_players", "n_promoted", "promo_rate", "archetype"))).alias("profiles"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct(part, "profiles"))).alias("profiles"))


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """S-A5: profiles document -> one row per (position, cluster)."""
    doc = read_json(spark, path, f"profiles map<string,array<{PROFILE_STRUCT}>>")
    per = doc.select(F.explode("profiles").alias("position", "items"))
    return per.select("position", F.inline("items"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """S-A5: model metrics document ``{model: {metric: value}}`` -> (model, metric, value)."""
    doc = read_json(spark, path, "models map<string,map<string,double>>")
    per = doc.select(F.explode("models").alias("model", "metrics"))
    return per.select("model", F.explode("metrics").alias("metric", "value"))


def read_freshness(spark: SparkSession, path: str) -> DataFrame:
    """S-A5: run metadata (one row): newest date, years, rows, players."""
    return read_json(spark, path, "data_max_date string, data_years array<int>, n_rows bigint, n_players bigint")


def read_careers(spark: SparkSession, path: str) -> DataFrame:
    """S-A5: careers ``player -> year -> leagues`` with the leagues as sorted sets."""
    doc = read_json(spark, path, "player string, career map<string,array<string>>")
    rows = doc.select("player", F.explode("career").alias("year", "leagues"))
    return rows.select("player", F.col("year").try_cast("int").alias("year"),
                       F.array_sort(F.array_distinct("leagues")).alias("leagues"))


def read_sweep(spark: SparkSession, path: str) -> DataFrame:
    """H-5: sweep documents, one per position with parallel lists over k, -> one row per (position, k).

    Lists are paired by place; a list that is shorter than ``k_range`` gives null there, a document
    without ``k_range`` (or an unreadable one) gives no row.
    """
    doc = read_json(spark, path, "position string, k_range array<int>, inertias array<double>, "
                                 "silhouettes array<double>, best_k int")
    at = doc.select("position", "best_k", "inertias", "silhouettes", F.posexplode("k_range").alias("i", "k"))
    return at.select("position", "k", F.get("inertias", F.col("i")).alias("inertia"),
                     F.get("silhouettes", F.col("i")).alias("silhouette"),
                     F.coalesce(F.col("k") == F.col("best_k"), F.lit(False)).alias("is_best"))


def sweep_documents(sweep: DataFrame, part: str = "position") -> DataFrame:
    """H-5: one document per position from the sweep's (position, k, inertia, silhouette, is_best) rows;
    its lists hold one entry per k, which the sweep's range bounds."""
    per = sweep.groupBy(F.col(part).alias("position")).agg(
        F.array_sort(F.collect_list(F.struct("k", "inertia", "silhouette"))).alias("s"),
        F.min(F.when(F.col("is_best"), F.col("k"))).alias("best_k"))
    return per.select("position", F.col("s.k").alias("k_range"), F.col("s.inertia").alias("inertias"),
                      F.col("s.silhouette").alias("silhouettes"), "best_k")


def read_k_scores(spark: SparkSession, path: str) -> DataFrame:
    """S-A5: k-sweep document -> one row per (position, k)."""
    return read_json(spark, path, "position string, k int, inertia double, silhouette double, "
                                  "best_k int, is_best boolean")
