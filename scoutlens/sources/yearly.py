"""Yearly CSV scan with provenance (S-A1).

The files of all years are listed first; a census then reads every file's header in one
job, each file in a task of its own that stops after its first lines. Files that have no
readable header (empty, not text, a broken archive, gone since the listing) are set apart
with a warning. Files of one year and header are one scan; columns are read as text and
scans are united by name, so files may order columns differently.

Driver work is one listing row per file. A file whose header is fine and whose later part
is damaged fails the query that reads it: its rows are never dropped silently.
"""

from __future__ import annotations

import logging
import re
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import check_columns, check_numbers

log = logging.getLogger(__name__)

WHOLE_FILE = 1 << 44          # bytes: no file is split, and no two files share a task


@contextmanager
def _a_task_per_file(spark: SparkSession):
    """Files are planned one to a task while this is open (planning happens at the action)."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(WHOLE_FILE))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def list_files(spark: SparkSession, root: str, years: list[int], pattern: str = "{year}_*.csv") -> list[tuple]:
    """(year, URL of the file) in order; years without a file are skipped with a warning. Runs no job."""
    found = []
    for y in years:
        try:                                              # only lists; contents are not read
            files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{pattern.format(year=y)}")
        except AnalysisException as e:
            log.warning("year %s skipped: %s", y, str(e).splitlines()[0])
            continue
        found += [(int(y), f) for f in sorted(files.inputFiles())]
    return found


def _first(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(batch.slice(0, 1).columns, names=["file", "header"])
            return


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header): the first line of every file that is not blank, as bytes. One job; a file
    that cannot be read, or has no such line, has no row."""
    lines = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(paths)
    lines = lines.where(F.length(F.trim("value")) > 0)
    return lines.select("_metadata.file_path", F.col("value").cast("binary")).mapInArrow(_first, "file string, header binary")


def census(spark: SparkSession, root: str, years: list[int], pattern: str = "{year}_*.csv") -> list[dict]:
    """One entry per file, by year and path: path, year, header (text; None if unreadable)."""
    listed = list_files(spark, root, years, pattern)
    if not listed:
        return []
    with _a_task_per_file(spark):
        seen = {_key(r["file"]): _text(r["header"]) for r in headers(spark, [unquote(f) for _, f in listed]).collect()}
    return [{"path": unquote(f), "year": y, "header": seen.get(_key(f))} for y, f in listed]


def _key(url: str) -> str:
    """One spelling of a file's URL: listings and scans differ in the slashes after the scheme."""
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", unquote(url))


def _text(header: bytes) -> str | None:
    try:
        text = bytes(header).decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if "\x00" in text else text


def load_yearly(spark: SparkSession, root: str, years: list[int],
                pattern: str = "{year}_*.csv", required=None, optional=(),
                year_col: str = "_source_year", numeric=()) -> DataFrame:
    """S-A1: all files of all years, tagged with their year, columns as text.

    A missing year and an unreadable file are skipped with a warning; a schema error
    (missing required columns, text in one of the ``numeric`` columns) is raised naming
    every column. Typing is left to ``try_cast`` downstream.
    """
    scans: dict[tuple, list[str]] = {}
    for f in census(spark, root, years, pattern):
        if f["header"] is None:
            log.warning("file %s of year %s skipped: no readable header", f["path"], f["year"])
        else:
            scans.setdefault((f["year"], f["header"]), []).append(f["path"])
    if not scans:
        raise FileNotFoundError(f"no yearly file under {root} for {years}")
    # names as the CSV reader itself makes them (quotes, blanks, repeats): one look per different header
    names: dict[str, list[str]] = {}
    for (_, header), paths in scans.items():
        if header not in names:
            names[header] = spark.read.option("header", True).csv(paths[0]).columns
    out = None
    for (year, header), paths in scans.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names[header]])
        df = spark.read.option("header", True).schema(schema).csv(paths)
        if required is not None:
            check_columns(df, required, optional)         # raises SchemaValidationError
        if numeric:
            check_numbers(df, numeric)
        df = df.withColumn(year_col, F.lit(year))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
