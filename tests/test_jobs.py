"""End-to-end loads from landing directories of real files."""

import json
import os

import pytest
from pyspark.errors import PySparkException

from civicspark.plans import jobs
from tests.test_feeds import DOC, PAGE, SURVEY, variant


def land(d, name, payload):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def test_request_load_modes_and_lineage(spark, tmp_dir):
    land(f"{tmp_dir}/in", "page0.json", PAGE)
    land(f"{tmp_dir}/in", "page1.json", json.dumps(
        [{"unique_key": "3", "created_date": "2024-01-01T00:00:00.000"}]))
    table = f"{tmp_dir}/requests_raw"
    n_inc = jobs.load_requests(spark, f"{tmp_dir}/in", table, "incremental",
                               as_of="2024-05-03 12:00:00", ingested_at="2024-05-03 12:00:00")
    n_hist = jobs.load_requests(spark, f"{tmp_dir}/in", table, "historical",
                                as_of="2024-05-03 12:00:00", ingested_at="2024-05-03 13:00:00")
    assert (n_inc, n_hist) == (2, 2)           # key 3 is older than 90 days
    got = spark.read.parquet(table)
    assert got.count() == 4
    assert {r._ingestion_mode for r in got.collect()} == {"incremental", "historical"}
    assert jobs.load_requests(spark, f"{tmp_dir}/in", table, "incremental",
                              as_of="2025-01-01 00:00:00") == 0   # empty: nothing written
    with pytest.raises(ValueError):
        jobs.load_requests(spark, f"{tmp_dir}/in", table, "monthly")


def test_request_load_over_length_is_all_or_nothing(spark, tmp_dir):
    land(f"{tmp_dir}/in", "page.json", json.dumps(
        [{"unique_key": "1", "created_date": "2024-05-03T00:00:00.000"},
         {"unique_key": "2" * 60, "created_date": "2024-05-03T00:00:00.000"}]))
    table = f"{tmp_dir}/requests_raw"
    with pytest.raises(PySparkException):
        jobs.load_requests(spark, f"{tmp_dir}/in", table, "incremental", as_of="2024-05-03 12:00:00")
    assert not os.path.exists(table) or not [f for f in os.listdir(table) if f.endswith(".parquet")]


def test_weather_load_per_borough_partition(spark, tmp_dir):
    for b in ["Manhattan", "Brooklyn"]:
        land(f"{tmp_dir}/wx/borough={b}", "obs.json", DOC)
    table = f"{tmp_dir}/weather_raw"
    assert jobs.load_weather(spark, f"{tmp_dir}/wx", table, "2024-05-02 00:00:00") == 2
    assert {r.borough for r in spark.read.parquet(table).collect()} == {"Manhattan", "Brooklyn"}
    land(f"{tmp_dir}/wx/borough=Queens", "obs.json", variant(main__temp=...))
    with pytest.raises(PySparkException):
        jobs.load_weather(spark, f"{tmp_dir}/wx", table, "2024-05-03 00:00:00")
    assert spark.read.parquet(table).count() == 2        # failed load added nothing


def test_survey_load_is_idempotent_upsert(spark, tmp_dir):
    land(f"{tmp_dir}/census", "acs.json", SURVEY)
    table = f"{tmp_dir}/census_raw"
    assert jobs.load_survey(spark, f"{tmp_dir}/census", table, "2024-05-01 00:00:00") == 2
    assert jobs.load_survey(spark, f"{tmp_dir}/census", table, "2024-06-01 00:00:00") == 2
    rows = spark.read.parquet(table).collect()
    assert len(rows) == 2 and {r._ingested_at.month for r in rows} == {6}
    jobs.load_survey(spark, f"{tmp_dir}/census", table, "2024-06-01 00:00:00", survey_year=2023)
    assert spark.read.parquet(table).count() == 4


def test_day_partitioned_requests_prune_to_the_window(spark, tmp_dir):
    land(f"{tmp_dir}/in", "page.json", json.dumps(
        [{"unique_key": str(i), "created_date": f"2024-04-{1 + i % 30:02d}T10:00:00.000"}
         for i in range(300)]))
    table = f"{tmp_dir}/requests_raw"
    assert jobs.load_requests(spark, f"{tmp_dir}/in", table, "historical", as_of="2024-05-01 00:00:00",
                              partition_by_day=True) == 300
    assert len([d for d in os.listdir(table) if d.startswith("_created_day=")]) == 30
    from pyspark.sql import functions as F
    recent = spark.read.parquet(table).filter(F.col("_created_day") >= "2024-04-28")
    assert recent.count() == 30
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_created_day" in plan
