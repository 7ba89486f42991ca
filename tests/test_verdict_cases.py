"""Inputs that used to lose or change rows without an error."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from civicspark.functions import scalars as X
from civicspark.operators import history, weather
from civicspark.operators.ordered import shift_within
from civicspark.sinks import tables as sinks
from civicspark.session import shared_path
from civicspark.sources.landing import explode_census_docs, explode_request_pages, parse_weather_docs
from civicspark.streaming import feeds


def test_round_exact_equals_python(spark):
    vals = [0.125, 1.005, 17.345, 3.125, 2.675, 0.625, 62.5, 99.995, 0.005, 0.015, -2.675, -0.125, 1e6 + 0.125]
    vals += [100 * f / n for n in range(1, 120) for f in range(n + 1)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r[0] for r in df.select(X.round_exact("x", 2)).collect()] == [round(v, 2) for v in vals]


@pytest.mark.parametrize("text", ['[{"unique_key":"1"}', "{", "[1, 2"])
def test_malformed_page_fails(spark, text):
    pages = spark.createDataFrame([('[{"unique_key":"0"}]',), (text,)], "value string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        explode_request_pages(pages).collect()


@pytest.mark.parametrize("text", ['[["NAME"],["a"]', "[]"])
def test_broken_survey_fails(spark, text):
    with pytest.raises((PySparkException, Py4JJavaError)):
        explode_census_docs(spark.createDataFrame([(text,)], "value string")).collect()


@pytest.mark.parametrize("text", ["", "  \n"])
def test_blank_payloads_fail(spark, text):
    one = spark.createDataFrame([(text,)], "value string")
    for explode in (explode_request_pages, explode_census_docs):
        with pytest.raises((PySparkException, Py4JJavaError)):
            explode(one).collect()


def test_a_broken_observation_fails_even_a_count(spark):
    docs = spark.createDataFrame([("Bronx", json.dumps({"dt": 1}))], "borough string, value string")
    rows = weather.flatten(parse_weather_docs(docs), "2024-01-01 00:00:00")
    for read in (rows.count, rows.select("lat").collect, rows.select("_source").collect):
        with pytest.raises((PySparkException, Py4JJavaError)):
            read()


def test_stream_upsert_takes_keyless_rows_once(spark, tmp_dir):
    table = shared_path(spark, "test-keyless")

    def run(name, records, checkpoint):
        os.makedirs(f"{tmp_dir}/{name}", exist_ok=True)
        with open(f"{tmp_dir}/{name}/p.json", "w") as f:
            json.dump(records, f)
        rows = feeds.request_stream(spark, f"{tmp_dir}/{name}", ingested_at="2024-05-02 00:00:00")
        feeds.upsert_latest_requests(rows, table, f"{tmp_dir}/{checkpoint}").awaitTermination()
        return sorted((r.unique_key or "", r.status) for r in spark.read.parquet(table).collect())

    base = {"created_date": "2024-05-01T10:00:00.000"}
    first = [{"unique_key": "", "status": "a", **base}, {"unique_key": None, "status": "b", **base}, {"unique_key": "", "status": "a", **base},
             {"unique_key": "1", "status": "Open", **base}]
    want = [("", "a"), ("", "b"), ("1", "Open")]
    assert run("x", first, "c1") == want
    assert run("x", first, "c2") == want                       # delivered again: nothing new
    assert run("y", [{"unique_key": "", "status": "c", **base}], "c3") == sorted([*want, ("", "c")])


def test_null_key_shifts_like_any_other(spark):
    df = spark.createDataFrame([(None, i) for i in range(40)] + [("a", i) for i in range(5)], "k string, t int")
    got = shift_within(df, ["k"], ["t"], ["t"], n_partitions=4)
    assert got.filter("k is null and not prev__exists").count() == 1
    assert got.filter("k is null and t > 0 and prev_t != t - 1").count() == 0


def test_upsert_keeps_undated_rows_and_text_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    schema = "k string, v int, day string"
    sinks.append(spark.createDataFrame([("A", 1, None), ("X", 1, "005")], schema), path, partition_by=["day"])
    sinks.upsert(spark.createDataFrame([("B", 2, None), ("Y", 2, "061")], schema), path, ["k"], ["v"], partition_col="day")
    rows = {tuple(r) for r in spark.read.schema(schema).parquet(path).select("k", "v", "day").collect()}
    assert rows == {("A", 1, None), ("B", 2, None), ("X", 1, "005"), ("Y", 2, "061")}


def test_latest_row_prefers_closed_and_keeps_keyless_rows(spark):
    rows = [("1", "Open", "", 5), ("1", "Closed", "", 5), ("2", "Closed", "2024-01-02", 5), ("2", "Open", "", 6)]
    rows += [("", "Open", "", i) for i in range(3)] + [(None, "Open", None, 1)]
    df = spark.createDataFrame(rows, "unique_key string, status string, closed_date string, _ingested_at int")
    got = sorted((r.unique_key or "", r.status) for r in history.latest_request_rows(df).collect())
    assert got == [("", "Open")] * 4 + [("1", "Closed"), ("2", "Open")]
