"""The driver contract, and a sample of queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import normalised

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@needs_data
def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", [
    "clean_lt_daily", "clean_snow_chunked", "resample_all_rules", "moving_avg_centered_chunked", "water_balance", "lake_evaporation",
    "kde", "poly_fit_quadratic", "overlay_merge", "request_plan", "load_history", "spring_snow_panel", "winter_panel_daily", "stream_daily",
])
def test_query_against_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normalised(got) == normalised(want) and len(got) > 0
