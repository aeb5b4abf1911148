"""Every registered query against its DuckDB twin (or a row check where SQL cannot express it)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from quayside.sources.tables import TABLES, table_path  # noqa: E402

KEYS = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 36 and df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, duck, key):
    got = entry.queries()[key](spark, sf_dir).toPandas()
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0
        return
    result = compare(got, duck.execute(sql).df())
    assert result.startswith("OK"), result
