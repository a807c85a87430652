"""Every query with an oracle matches DuckDB on sf0.001 (driver-style comparison)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import oracle_check as OC  # noqa: E402
from scoutlens.plans import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in OC.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    sp = QUERIES[key](spark, SF).toPandas()
    dd = con.execute(ORACLE[key]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert OC.digest(OC.norm(sp)) == OC.digest(OC.norm(dd))
