"""Keyed upsert: contract, NULL overwrite, idempotence, partition-only rewrite."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from civicspark import schemas
from civicspark.operators.upsert import merge
from civicspark.sinks import tables as sinks
from civicspark.session import shared_path

SCHEMA = schemas.struct_type(schemas.CENSUS_RAW)
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def row(b, year, pop, county="061", source="old", at=T0):
    return (b, county, "36", year, pop, 1.0, 2.0, 3.0, 4.0, 5.0, at, source)


def test_merge_contract(spark):
    target = spark.createDataFrame([row("Manhattan", 2022, 10.0), row("Bronx", 2022, 20.0)], SCHEMA)
    source = spark.createDataFrame([row("Manhattan", 2022, None, county="999", source="new", at=T1),
                                    row("Queens", 2022, 30.0, source="new", at=T1)], SCHEMA)
    out = {r.borough: r for r in merge(target, source, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE).collect()}
    assert set(out) == {"Manhattan", "Bronx", "Queens"}
    m = out["Manhattan"]
    assert m.total_population is None                 # source NULL overwrites
    assert m.county_fips == "061" and m._source == "old"   # not in the update set
    assert m._ingested_at == T1
    assert out["Queens"]._source == "new" and out["Bronx"].total_population == 20.0


def test_duplicate_source_keys_rejected(spark):
    t = spark.createDataFrame([row("Manhattan", 2022, 1.0)], SCHEMA)
    s = spark.createDataFrame([row("Queens", 2022, 1.0), row("Queens", 2022, 2.0)], SCHEMA)
    with pytest.raises(ValueError):
        merge(t, s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE)


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([row(None, 2022, 1.0)], SCHEMA)
    s = spark.createDataFrame([row(None, 2022, 2.0)], SCHEMA)
    assert merge(t, s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE).count() == 2


def test_sink_upsert_idempotent_and_partition_only(spark):
    path = shared_path(spark, "test-upsert")
    base = spark.createDataFrame([row("Manhattan", 2021, 1.0), row("Manhattan", 2022, 2.0)], SCHEMA)
    sinks.append(base, path, partition_by=["survey_year"])
    untouched = sorted(os.listdir(path.removeprefix("file:") + "/survey_year=2021"))
    src = spark.createDataFrame([row("Manhattan", 2022, 9.0, at=T1), row("Bronx", 2022, 3.0, at=T1)], SCHEMA)
    assert sinks.upsert(src, path, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE, "survey_year") == 2
    first = sorted(map(tuple, spark.read.parquet(path).select(*SCHEMA.names).collect()), key=str)
    sinks.upsert(src, path, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE, "survey_year")
    second = sorted(map(tuple, spark.read.parquet(path).select(*SCHEMA.names).collect()), key=str)
    assert first == second and len(first) == 3
    assert sorted(os.listdir(path.removeprefix("file:") + "/survey_year=2021")) == untouched


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 30), max_size=12), st.sets(st.integers(0, 30), max_size=12))
def test_row_count_is_union_of_keys(spark, tkeys, skeys):
    t = spark.createDataFrame([row(f"b{k}", 2022, 1.0) for k in tkeys], SCHEMA)
    s = spark.createDataFrame([row(f"b{k}", 2022, 2.0, at=T1) for k in skeys], SCHEMA)
    small = merge(t, s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE).collect()
    full = merge(t, s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE, broadcast_rows=0).collect()
    assert sorted(map(tuple, small), key=str) == sorted(map(tuple, full), key=str)
    assert len(small) == len(tkeys | skeys)
    assert all(r.total_population == (2.0 if int(r.borough[1:]) in skeys else 1.0) for r in small)


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_both_paths_keep_null_key_rows(spark, broadcast_rows):
    t = spark.createDataFrame([row(None, 2022, 1.0), row("Bronx", 2022, 1.0)], SCHEMA)
    s = spark.createDataFrame([row(None, 2022, 2.0), row("Bronx", 2022, 5.0, at=T1)], SCHEMA)
    out = merge(t, s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE, broadcast_rows=broadcast_rows)
    got = sorted(((r.borough, r.total_population) for r in out.collect()), key=str)
    assert got == sorted([(None, 1.0), (None, 2.0), ("Bronx", 5.0)], key=str)


def test_small_source_does_not_shuffle_target(spark):
    t = spark.range(10000).selectExpr("concat('b', id) as borough", "'061' as county_fips",
                                      "'36' as state_fips", "2022 as survey_year",
                                      "1.0 as total_population", "1.0 as median_household_income",
                                      "1.0 as population_below_poverty", "1.0 as total_housing_units",
                                      "1.0 as total_workers_commuting", "1.0 as poverty_rate_pct",
                                      "timestamp_ntz'2024-01-01 00:00:00' as _ingested_at",
                                      "'old' as _source")
    s = spark.createDataFrame([row("b5", 2022, 9.0, at=T1), row("new", 2022, 3.0, at=T1)], SCHEMA)
    out = merge(t.select(*SCHEMA.names), s, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE)
    assert out.count() == 10001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
