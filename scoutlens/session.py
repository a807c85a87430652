"""Spark session defaults and the shared checkpoint folder.

Every operator in the package is a lazy DataFrame -> DataFrame function; the
session only fixes the engine settings they rely on:

* AQE with partition coalescing and skew-join splitting, so a league / player /
  position that holds a third of all rows is split across tasks when it meets a
  shuffle join;
* UTC session time zone (event times are zone-less in the inputs);
* ANSI mode stays on (the Spark 4 default): operators use ``try_*`` functions
  and guarded divisions where the reference coerces bad values to missing.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "scoutlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SCOUTLENS_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS / object
    store); we never override it, and without it we refuse to run. Only in
    local mode with nothing configured (tests) a fresh scratch folder is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset config raises
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store); "
                               "a machine-local scratch folder is only used in local mode")
        conf_dir = tempfile.mkdtemp(prefix="scoutlens-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)   # only the folder made here
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it
    back: a stage boundary that cuts lineage (columnar and compressed, unlike an
    RDD checkpoint) and survives executor loss."""
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
