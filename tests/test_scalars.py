import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from civicspark.functions import scalars as X


def one(spark, col, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_safe_float_grammar_and_sentinels(spark):
    data = [("12",), (" 12.5 ",), ("1e3",), ("-666666666",), ("-1.5",), ("N/A",), ("",), (None,),
            ("1d",), ("0x1p3",), ("nan",), ("inf",), ("-0.0",), (".5",)]
    got = one(spark, X.safe_float("x"), data)
    assert got[:9] == [12.0, 12.5, 1000.0, None, None, None, None, None, None]
    assert got[9] is None                     # Java-only hex float rejected
    assert math.isnan(got[10])                # nan passes the sentinel rule
    assert got[11] == math.inf
    assert got[12] == 0.0 and got[13] == 0.5


def test_guarded_rate(spark):
    data = [(125.0, 1000.0), (5.0, 0.0), (None, 10.0), (0.0, 10.0), (1.0, float("nan")),
            (1.0, None), (2.0, 3.0)]
    got = one(spark, X.guarded_rate("b", "t"), data, "b double, t double")
    assert got == [12.5, None, None, 0.0, None, None, 66.67]


def test_get_or_default_missing_vs_null(spark):
    df = spark.sql("select map('a', '1', 'b', cast(null as string)) m")
    r = df.select(X.get_or_default("m", "a", ""), X.get_or_default("m", "b", ""),
                  X.get_or_default("m", "c", "")).first()
    assert tuple(r) == ("1", None, "")


def test_lookup_or_default(spark):
    got = one(spark, X.lookup_or_default({"061": "Manhattan"}, F.col("x"), "Unknown"),
              [("061",), ("999",), (None,)])
    assert got == ["Manhattan", "Unknown", "Unknown"]


def test_epoch_round_trip_is_zone_independent(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.sql("select 1714600000 as e").select(X.epoch_to_ntz("e").alias("t")).first()
        assert r.t == dt.datetime(2024, 5, 1, 21, 46, 40)
        back = spark.createDataFrame([(r.t,)], "t timestamp_ntz").select(X.ntz_to_epoch("t")).first()[0]
        assert back == 1714600000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_to_ntz(spark):
    got = one(spark, X.iso_to_ntz("x"),
              [("2024-05-01T08:15:00.000",), ("2024-05-01T08:15:00+00:00",), ("",), ("junk",), (None,)])
    assert got[0] == got[1] == dt.datetime(2024, 5, 1, 8, 15)
    assert got[2:] == [None, None, None]


def test_lookback_bound_modes(spark):
    r = spark.range(1).select(
        X.lookback_bound("incremental", "2024-05-10 17:30:00").alias("i"),
        X.lookback_bound("historical", dt.datetime(2024, 5, 10, 0, 0, 1)).alias("h")).first()
    assert r.i == dt.datetime(2024, 5, 7)
    assert r.h == dt.datetime(2024, 2, 10)
    with pytest.raises(ValueError):
        X.lookback_bound("weekly", "2024-05-10 00:00:00")


def test_over_length_and_normalise(spark):
    assert one(spark, X.over_length("x", 3), [("abcd",), ("abc",), (None,)]) == [True, False, False]
    assert one(spark, X.normalise_borough("x"), [("  staten   island ",), ("Bronx",)]) == \
        ["STATEN ISLAND", "BRONX"]


def test_local_day_handles_dst(spark):
    data = [(dt.datetime(2024, 1, 15, 3, 0),), (dt.datetime(2024, 7, 15, 3, 30),),
            (dt.datetime(2024, 7, 15, 4, 30),)]
    got = one(spark, X.local_day("x"), data, "x timestamp_ntz")
    assert got == [dt.date(2024, 1, 14), dt.date(2024, 7, 14), dt.date(2024, 7, 15)]
