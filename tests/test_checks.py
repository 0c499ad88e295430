"""A few queries against their SQL texts on the smallest tables; `python -m checks.compare` runs all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import TABLES, _canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_text_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


NAMES = ["feature_table", "score_features_fractional", "load_people", "catalogue_assembly", "pr_curve_orders", "describe_lines", "stream_ingest"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    want = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(want.fetchall(), columns)


def test_every_sql_text_can_be_prepared(con):
    broken = {}
    for name, text in contract.oracle_sql().items():
        try:
            con.execute(f"EXPLAIN {text}")
        except duckdb.Error as e:
            broken[name] = str(e)
    assert not broken
