"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    result = compare(entry_module.queries()[name](spark, SF), con, entry_module.oracle_sql()[name])
    assert result.startswith("ok") and "TYPES" not in result, result


def test_names():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0


def test_features_hold_one_strategy_per_side(spark):
    df = entry_module.queries()["feature_table"](spark, SF)
    assert df.where("strategy_home is null or strategy_away is null").count() == 0
    assert "attendance" not in df.columns and "occupancy" in df.columns
