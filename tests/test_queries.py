"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from registry.book import QUERIES
from registry.compare import compare, connect

SLOW = {"gbt_train_predict", "rf_train_predict", "rf_quantiles", "prediction_records", "forecast_facts"}  # full-size forests


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_sql(spark, sf, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql, f"{name} has no SQL"
    assert compare(entry.queries()[name](spark, sf), con, sql) == ""


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "feature_time" in df.columns


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
