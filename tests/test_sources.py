"""Yearly scan with unreadable files, partition-wise stage tables, sweep documents."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from scoutlens.operators.quality import SchemaValidationError
from scoutlens.sources import files, stage_table, yearly


def put(folder, name, text):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_yearly_scan_sets_unreadable_files_apart(spark, tmp_path, caplog):
    root = str(tmp_path)
    put(root, "2020_a.csv", "game,league\n1,x\n2,y\n")
    put(root, "2020_b.csv", "\n  \nleague,game,more\nz,3,m\n")          # blank lines first, another order
    put(root, "2020_c.csv", "")                                           # empty
    put(root, "2021_a.csv", 'game,"league"\n4,"a\nb"\n')                # quoted header
    put(root, "2021_b.csv", b"\x00\x01\x02binary\n\xff\xfe")             # not text
    put(root, "2021_c.csv", b"g\xe9me,league\n9,x\n")                    # not UTF-8
    put(root, "2022_a.csv.gz", b"this is no gzip archive, whatever its name says")
    put(root, "2022_b.csv.gz", gzip.compress(b"game,league\n5,w\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with caplog.at_level("WARNING"):
        df = files.load_yearly(spark, root, [2019, 2020, 2021, 2022], "{year}_*.csv*", required=["game", "league"])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    rows = {(r["game"], r["league"], r["_source_year"], r["more"]) for r in df.where("game <> 'b\"'").collect()}
    assert {("1", "x", 2020, None), ("2", "y", 2020, None), ("3", "z", 2020, "m"), ("5", "w", 2022, None)} <= rows
    skipped = [r.getMessage() for r in caplog.records if "skipped" in r.getMessage()]
    assert sum("file " in m for m in skipped) == 4 and any("2019" in m for m in skipped)
    for name in ("2020_c.csv", "2021_b.csv", "2021_c.csv", "2022_a.csv.gz"):
        assert any(name in m for m in skipped)
    put(root, "2021_d.csv", "game,other\n1,2\n")
    with pytest.raises(SchemaValidationError):
        files.load_yearly(spark, root, [2020, 2021], required=["game", "league"])
    with pytest.raises(FileNotFoundError):
        files.load_yearly(spark, root, [1990])


def test_census_is_one_job_of_one_task_per_file(spark, tmp_path):
    root, n = str(tmp_path), 300
    for i in range(n):
        put(root, f"2020_{i:04d}.csv", f"game,league\n{i},x\n")
    files_ = [os.path.join(root, f) for f in os.listdir(root)]
    with yearly._a_task_per_file(spark):
        assert yearly.headers(spark, files_).rdd.getNumPartitions() == n
    df = files.load_yearly(spark, root, [2020], required=["game"])
    assert df.count() == n and df.agg(F.countDistinct("game")).first()[0] == n
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 1     # one header, one scan


def snapshot(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def test_one_year_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4 + 2000).cast("int").alias("_source_year"))
    assert files.replace_partitions(df, path) == 1
    before = snapshot(path)
    files.replace_partitions(df.where("_source_year = 2001 AND id < 50").withColumn("note", F.lit("n")), path)
    assert all(snapshot(path)[f] == t for f, t in before.items())
    got = {(r["id"], r["_source_year"], r["note"]) for r in files.read_partitions(spark, path).collect()}
    want = {(i, i % 4 + 2000, "n" if i % 4 == 1 else None) for i in range(100) if i % 4 != 1 or i < 50}
    assert got == want
    assert files.read_partitions(spark, path).columns == ["id", "_source_year", "note"]
    plan = files.read_partitions(spark, path).where("_source_year = 2002")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_source_year" in plan


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40).select("id", (F.col("id") % 2 + 2000).cast("int").alias("_source_year"))
    files.replace_partitions(df, path)
    bad = df.withColumn("id", F.when(F.col("id") == 33, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        files.replace_partitions(bad, path)
    assert files.read_partitions(spark, path).count() == 40
    assert stage_table.manifest(spark, path)["version"] == 1
    os.makedirs(f"{path}/manifests/version=2")            # what a writer lost in its last step leaves behind
    assert files.read_partitions(spark, path).count() == 40
    assert files.replace_partitions(df.where("id < 3"), path) == 2
    assert files.read_partitions(spark, path).count() == 3


def test_stage_table_edges(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        files.read_partitions(spark, path)
    df = spark.createDataFrame([(1, "a b", None), (2, "c/d=e%", 1.5), (3, None, 2.0)], "id long, team string, x double")
    files.replace_partitions(df, path, ["team"])
    assert {tuple(r) for r in files.read_partitions(spark, path).collect()} == {tuple(r) for r in df.collect()}
    files.replace_partitions(df.limit(0), path, ["team"])  # replaces nothing
    assert files.read_partitions(spark, path).count() == 3
    with pytest.raises(ValueError, match="column id"):
        files.replace_partitions(df.withColumn("id", F.lit("x")), path, ["team"])
    with pytest.raises(ValueError, match="partitioned"):
        files.replace_partitions(df, path, ["id"])
    files.replace_partitions(df.limit(0), path, ["team"], whole=True)
    empty = files.read_partitions(spark, path)
    assert empty.count() == 0 and empty.columns == ["id", "team", "x"]


def test_sweep_documents(spark, tmp_path):
    root = str(tmp_path)
    put(root, "a.json", '{"position": "Mid", "k_range": [2, 3, 4], "inertias": [9.5, 7.0], "silhouettes": [0.1, 0.3, 0.2], "best_k": 3}\n'
                        '{"position": "Top", "best_k": 2}\n{"position": "Bot", "k_range": [2], "inertias": [1], "silhouettes": [null]}\n')
    rows = {tuple(r) for r in files.read_sweep(spark, root).collect()}
    assert rows == {("Mid", 2, 9.5, 0.1, False), ("Mid", 3, 7.0, 0.3, True), ("Mid", 4, None, 0.2, False),
                    ("Bot", 2, 1.0, None, False)}
