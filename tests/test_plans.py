"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as E
from civicspark.operators import requests
from civicspark.plans import catalog
from tests.conftest import SF_SMALL

SIDE_EFFECT = {"census_merge", "requests_append", "weather_append"}   # they write while building


def plan(df) -> str:
    """Physical plan text as ``explain("formatted")`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", [k for k in catalog.QUERIES if k not in SIDE_EFFECT])
def test_no_python_evaluation(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in p, f"{name} evaluates Python: {node}"


def test_time_bound_pushed_to_parquet(spark):
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = requests.window_for_mode(e, "incremental", "2024-01-20 00:00:00", col="ts")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_time_bound_of_a_text_column_pushed_and_exact(spark, tmp_dir):
    texts = ["2024-01-16T23:59:59.999", "2024-01-17T00:00:00.000", "2024-01-17", " 2024-01-18T01:00:00", "2024-1-17", "2024-1-9",
             "2024-02-01 00:00:00", "+10000-01-01", "", None, "x", "2023-12-31T00:00:00"]
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(t,) for t in texts], "created_date string").write.parquet(path)
    df = requests.window_for_mode(spark.read.parquet(path), "incremental", "2024-01-20 00:00:00")
    assert "GreaterThanOrEqual(created_date,2024-01-17)" in plan(df)
    got = {r.created_date for r in df.collect()}
    assert {"2024-01-17T00:00:00.000", "2024-01-17", " 2024-01-18T01:00:00", "2024-1-17", "2024-02-01 00:00:00"} <= got
    assert not got & {"2024-01-16T23:59:59.999", "2024-1-9", "", None, "x", "2023-12-31T00:00:00"}


def test_latest_requests_read_their_input_once(spark):
    p = plan(catalog.requests_daily(spark, SF_SMALL))
    assert "Union" not in p and p.count("Scan parquet") <= 4        # each of the two tables in the tree and in the details


def test_projection_pruned_at_scan(spark):
    p = plan(catalog.weather_epoch(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_dimension_join_is_broadcast(spark):
    p = plan(catalog.requests_project(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_latest_row_combines_map_side(spark):
    p = plan(catalog.latest_request(spark, SF_SMALL))
    assert "partial_max_by" in p


@pytest.mark.parametrize("name", ["scd2_dimension", "weather_correlation", "latest_request",
                                  "daily_volume", "yoy_change"])
def test_no_single_partition_exchange(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in p
