"""Results must not depend on the session time zone."""

import duckdb
import pytest

import __spark_entry__ as E
from civicspark.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of

TIME_QUERIES = ["weather_epoch", "iso_to_timestamp", "local_day", "lookback_incremental",
                "requests_typed", "weather_flatten", "daily_volume", "scd2_dimension"]


@pytest.fixture
def other_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_same_result_in_another_session_zone(spark, other_zone, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()], True) == \
        rows_of(ocols, cur.fetchall(), True)
