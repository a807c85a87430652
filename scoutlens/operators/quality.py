"""Schema and data-quality checks (Q-B1 … Q-B5).

Schema checks are driver-side decisions on ``df.columns`` (no job). Data checks
are single-pass aggregates over the whole table (one job, one output row),
unpivoted with ``stack`` into (check, value, ok) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import to_number
from .target import as_timestamp


class SchemaValidationError(ValueError):
    """Raised when required columns are missing; names all of them at once."""


def check_columns(df: DataFrame, required=C.REQUIRED_COLUMNS,
                  optional=C.OPTIONAL_COLUMNS) -> list[str]:
    """Q-B1: raise naming *every* missing required column; return missing optionals."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise SchemaValidationError(f"missing required columns: {', '.join(missing)}")
    return [c for c in optional if c not in have]


def missing_columns_report(df: DataFrame, required, optional=()) -> DataFrame:
    """Q-B1 report form: one row per listed column ``(column, kind, present, non_null)``.

    Presence is a schema decision; ``non_null`` counts the column's values over
    the whole table (one aggregate pass), NULL for absent columns.
    """
    have = set(df.columns)
    listed = [(c, "required") for c in required] + [(c, "optional") for c in optional]
    present = [c for c, _ in listed if c in have]
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(present)]) \
        if present else df.agg(F.count("*").alias("_n"))
    idx = {c: i for i, c in enumerate(present)}
    arr = F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.lit(c in have).alias("present"),
        (F.col(f"_nn{idx[c]}") if c in have else F.lit(None).cast("long")).alias("non_null"))
        for c, kind in listed])
    return counts.select(F.inline(arr))


def check_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q-B2: per column, non-NULL values that do not parse as a number (whole table)."""
    cols = [c for c in cols if c in df.columns]
    agg = df.agg(*[F.count_if(F.col(c).isNotNull() & to_number(F.col(c)).isNull()
                              & ~F.lower(F.trim(F.col(c).cast("string"))).isin("nan"))
                   .alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, n_bad)")


def check_numbers(df: DataFrame, cols=C.NUMERIC_CHECK_COLUMNS) -> None:
    """Raise naming every listed column that holds text that is no number (whole table)."""
    have = [c for c in cols if c in df.columns]
    bad = [r for r in check_numeric(df, have).where("n_bad > 0").collect()] if have else []   # a row per column
    if bad:
        raise SchemaValidationError("non-numeric values in: " + ", ".join(
            f"{r['column']} ({r['n_bad']})" for r in sorted(bad, key=lambda r: r["column"])))


def validate(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES, div1=C.FEEDER_DIV1_LEAGUES,
             critical=("playername", "teamname", "league", "position"),
             min_players: int = 10) -> DataFrame:
    """Q-B3: dataset report as (check, value, ok) rows, from one aggregate."""
    crit = [c for c in critical if c in df.columns]
    has_t = roles.target in df.columns
    aggs = [
        F.count("*").alias("n_rows"),
        F.count_distinct(roles.player).alias("n_players"),
        F.array_join(F.array_sort(F.collect_set(
            F.when(F.col(roles.league).isin(list(div1)), F.col(roles.league)))), ",")
        .alias("div1_present"),
        F.count_if(F.col(roles.league) == F.lit(roles.top)).alias("n_top"),
        F.array_join(F.array_sort(F.collect_set(roles.position)), ",").alias("positions"),
        (F.count_if(F.col(roles.target)) if has_t else F.lit(None).cast("long")).alias("n_target"),
    ] + [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in crit]
    a = df.agg(*aggs)
    rate = F.round(F.try_divide(F.col("n_target") * 100.0, F.col("n_rows")), 2)
    crit_ok = F.lit(True)
    for c in crit:
        crit_ok = crit_ok & (F.col(f"null_{c}") == 0)
    players_ok = F.col("n_players") >= min_players
    target_ok = F.lit(has_t)
    rows = [
        ("non_empty", F.col("n_rows").cast("string"), F.col("n_rows") > 0),
        ("players", F.col("n_players").cast("string"), players_ok),
        ("feeder_div1_present", F.col("div1_present"), F.lit(True)),
        ("top_league_present", F.col("n_top").cast("string"), F.col("n_top") > 0),
        ("positions", F.col("positions"), F.lit(True)),
        ("target_rows", F.col("n_target").cast("string"), target_ok),
        ("target_rate_pct", rate.cast("string"), target_ok),
    ] + [(f"nulls_{c}", F.col(f"null_{c}").cast("string"), F.col(f"null_{c}") == 0)
         for c in crit]
    rows.append(("all_ok", F.lit(None).cast("string"),
                 (F.col("n_rows") > 0) & players_ok & target_ok & crit_ok))
    arr = F.array(*[F.struct(F.lit(n).alias("check"), v.alias("value"), ok.alias("ok"))
                    for n, v, ok in rows])
    return a.select(F.inline(arr))


def freshness(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """Q-B4: max parseable date (ISO day), sorted distinct years, rows, players."""
    d = as_timestamp(df, roles.date)
    return df.agg(
        F.date_format(F.max(F.to_date(d)), "yyyy-MM-dd").alias("data_max_date"),
        F.array_sort(F.collect_set(F.col(roles.year).cast("int"))).alias("data_years"),
        F.count("*").alias("n_rows"),
        F.count_distinct(roles.player).alias("n_players"),
    )


def null_census(df: DataFrame) -> DataFrame:
    """Q-B5: per column non-NULL and NULL counts (one pass), with the Spark type."""
    cols = df.columns
    a = df.agg(F.count("*").alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"nn_{i}")
                                             for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                             F.col(f"nn_{i}").alias("non_null"),
                             (F.col("_n") - F.col(f"nn_{i}")).alias("nulls"))
                    for i, c in enumerate(cols)])
    return a.select(F.inline(arr))
