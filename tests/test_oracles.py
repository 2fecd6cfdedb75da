"""The correctness gate: every registered query with an oracle equals DuckDB at sf0.01
(row count, column names, order-insensitive values); rows-only queries run; entry runs."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from aerolytics.sources.tables import TABLES
from tests.conftest import SF01
from tools.check_oracles import compare

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF01, f"{t}.parquet")
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 70


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, res = compare(name, QUERIES[name](spark, SF01), ORACLES[name], con)
    assert ok, res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["station", "rank", "hour", "time_label", "safety_score", "advice"]


ZONE_SENSITIVE = ["build_features", "resample_hourly", "resample_weekly", "stream_hourly_mean",
                  "fourier_features", "parse_timestamp", "split_time", "assemble_timestamp"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        ok, res = compare(name, QUERIES[name](spark, SF01), ORACLES[name], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, res
