"""Table contract, append accounting, empty loads, length checks."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from civicspark import constants as C
from civicspark import schemas
from civicspark.operators import quality
from civicspark.sinks import tables as sinks
from civicspark.session import shared_path


def test_append_returns_observed_count(spark):
    path = shared_path(spark, "test-append")
    df = spark.range(1234).selectExpr("cast(id as string) as unique_key")
    assert sinks.append(df, path, max_records_per_file=500) == 1234
    assert sinks.append(df, path) == 1234
    assert spark.read.parquet(path).count() == 2468


def test_empty_load_touches_nothing(spark, tmp_dir):
    path = shared_path(spark, "test-empty")
    empty = spark.createDataFrame([], "unique_key string")
    assert sinks.load_feed(empty, path, "requests_raw") == 0
    with pytest.raises(PySparkException):
        spark.read.parquet(path).count()


def test_conform_fills_defaults_and_orders(spark):
    df = spark.createDataFrame([("k1", dt.datetime(2024, 1, 1))], "unique_key string, _ingested_at timestamp_ntz")
    out = quality.conform(df, schemas.REQUESTS_RAW)
    assert out.columns == [c.name for c in schemas.REQUESTS_RAW]
    r = out.first()
    assert r._source == C.SOURCE_REQUESTS and r.closed_date is None and r.unique_key == "k1"


def test_catalog_table_enforces_declared_lengths(spark, tmp_dir):
    name = "requests_raw_contract_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.create_table(spark, name, "requests_raw", location=f"{tmp_dir}/t")
    sinks.create_table(spark, name, "requests_raw", location=f"{tmp_dir}/t")   # if-not-exists
    spark.sql(f"INSERT INTO {name} (unique_key, _ingestion_mode) VALUES ('1', 'historical')")
    r = spark.table(name).first()
    assert r._source == C.SOURCE_REQUESTS and r._ingested_at is not None     # defaults
    with pytest.raises(PySparkException):
        spark.sql(f"INSERT INTO {name} (unique_key) VALUES ('{'x' * 51}')")
    spark.sql(f"DROP TABLE {name}")


def test_length_violations_and_reject(spark):
    df = spark.createDataFrame([("abcdef", "x"), ("abc", None)], "a string, b string")
    got = {r.column_name: r for r in quality.length_violations(df, {"a": 5, "b": 1}).collect()}
    assert got["a"].n_over == 1 and got["a"].longest == 6 and got["b"].n_over == 0
    ok, bad = quality.reject_over_length(df, {"a": 5}, on_error="quarantine")
    assert ok.count() == 1 and bad.count() == 1
    with pytest.raises(PySparkException):
        quality.reject_over_length(df, {"a": 5}).collect()
