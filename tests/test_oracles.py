"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names, order-insensitive values), plus the entry smoke check."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tools_compare  # noqa: E402
from tools_compare import digest  # noqa: E402
from pansift.plans.registry import load_all  # noqa: E402
from pansift.plans.standins import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
REG = load_all()
SLOW: set = set()
tools_compare.STRICT = True  # floats hashed exactly: the registry's own rounding must make them agree


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n in REG if n not in SLOW))
def test_query_matches_oracle(spark, con, name):
    q = REG[name]
    got = q.run(spark, SF).toPandas()
    sql = q.oracle()
    if sql is None:
        assert len(got.columns) > 0
        return
    exp = con.execute(sql).df()
    c1, h1, _ = digest(got)
    c2, h2, _ = digest(exp)
    assert c1 == c2 and len(got) == len(exp) and h1 == h2


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
