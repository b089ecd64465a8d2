"""Driver contract and a DuckDB cross-check of every registered query on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from riverbend.plans.catalog import QUERIES
from riverbend.sources.tables import TABLES, table_path

from conftest import SF_SMALL
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check_oracle import rows_key  # noqa: E402


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == entry_mod.entry(spark).columns


def test_every_query_has_oracle_or_is_listed():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_key(df.columns, srows) == rows_key(dcols, drows)
