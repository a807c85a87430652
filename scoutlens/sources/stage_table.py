"""Stage tables whose partitions can be replaced one by one (S-A3).

A table is a folder with ``data/stage_write=N/<partitions>/`` (the files of the N-th write) and
``manifests/version=N/`` (one small JSON file: which write holds each partition, and the
schema). A write puts its files into a folder of its own and then adds a manifest of one
file, which appears at once or not at all. Readers follow the newest manifest: a write that
fails at any point leaves the table as it was, and replacing one year touches no file of
another. One writer at a time.

Superseded writes stay on disk, so readers of an older version are not disturbed.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "partitions map<string,bigint>, schema string, parts array<string>"


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest: version, partitions (folder -> number of the write), schema, parts."""
    try:
        docs = spark.read.schema(f"{MANIFEST}, version bigint").json(f"{path}/manifests")
    except AnalysisException:                             # no such folder: no table yet
        return None
    row = docs.orderBy(F.col("version").desc()).first()
    return row.asDict() if row else None


def replace_partitions(df: DataFrame, path: str, partition_by=("_source_year",), whole: bool = False) -> int:
    """Write ``df``; its partitions replace those of the same values, all others stay (``whole``: none stay).

    Columns that the table does not have are added (null in older partitions); a column of
    another type, or other partition columns, are refused. An empty ``df`` replaces nothing
    (``whole``: leaves an empty table). Returns the new version.
    """
    spark, parts = df.sparkSession, list(partition_by)
    old = manifest(spark, path)
    schema = df.schema if old is None or whole else _merged(T.StructType.fromJson(json.loads(old["schema"])), df.schema)
    if old and not whole and old["parts"] != parts:
        raise ValueError(f"table is partitioned by {old['parts']}, not {parts}")
    version = old["version"] + 1 if old else 1
    folder = f"{path}/data/stage_write={version}"
    # a failed write of this number was never in a manifest: its folder is written anew
    df.write.mode("overwrite").partitionBy(*parts).parquet(folder)
    held = dict(old["partitions"] or {}) if old and not whole else {}
    held.update({p: version for p in _folders(spark, folder, df.schema, parts)})
    doc = spark.range(1).select(
        F.from_json(F.lit(json.dumps(held)), "map<string,bigint>").alias("partitions"),
        F.lit(schema.json()).alias("schema"), F.array(*[F.lit(p) for p in parts]).alias("parts"))
    doc.coalesce(1).write.mode("overwrite").json(f"{path}/manifests/version={version}")
    return version


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its newest manifest, one scan; year filters prune folders."""
    m = manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no manifest under {path}")
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    if not m["partitions"]:
        return spark.createDataFrame([], schema)
    base = f"{path}/data"
    rows = spark.read.schema(schema).option("basePath", base).parquet(
        *[f"{base}/stage_write={n}/{p}" for p, n in sorted(m["partitions"].items())])
    return rows.select(*[F.col(f"`{c}`") for c in schema.names])


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType(list(old) + [f for f in new if f.name not in known])


def _folders(spark: SparkSession, folder: str, schema: T.StructType, parts: list[str]) -> set[str]:
    """The partition folders of one write, from the file listing."""
    depth = "/".join([r"[^/]+=[^/]*"] * len(parts))
    files = spark.read.schema(schema).parquet(folder).inputFiles()
    found = (re.search(rf"/({depth})/[^/]+$", unquote(f)) for f in files)
    return {m.group(1) for m in found if m}
