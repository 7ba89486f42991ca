"""Edge cases of the three feeds, one row per case (FIXTURES.md, SURVEY §1.4, §2.11)."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark.operators import census, requests, weather
from civicspark.sources.landing import explode_census_docs, explode_request_pages, parse_weather_docs

AT = "2024-05-02 00:00:00"


def text_df(spark, docs, **extra):
    rows = [(json.dumps(d) if not isinstance(d, str) else d, *extra.values()) for d in docs]
    cols = "value string" + "".join(f", {k} string" for k in extra)
    return spark.createDataFrame(rows, cols)


# --- requests ---------------------------------------------------------------------

PAGE = ('[{"unique_key":"1","created_date":"2024-05-01T08:15:00.000","complaint_type":"Noise",'
        '"borough":"BROOKLYN","status":"Open","agency":"A1","extra":"dropped"},'
        '{"unique_key":"2","created_date":"2024-05-01T08:15:00.000","closed_date":null,'
        '"latitude":"40.7","longitude":"-73.9"}]')


def test_request_page_missing_vs_null(spark):
    recs = explode_request_pages(text_df(spark, [PAGE]))
    rows = {r.unique_key: r for r in requests.to_requests_raw(recs, AT, "incremental").collect()}
    assert len(rows) == 2
    assert rows["1"].closed_date == "" and rows["1"].complaint_type == "Noise"
    assert rows["2"].closed_date is None            # JSON null stays NULL
    assert rows["2"].complaint_type == ""           # absent key -> ''
    assert "extra" not in requests.to_requests_raw(recs, AT, "incremental").columns
    assert rows["1"]._ingestion_mode == "incremental"
    assert rows["1"]._source == C.SOURCE_REQUESTS
    assert rows["1"]._ingested_at == dt.datetime(2024, 5, 2)


def test_request_window_inclusive_and_typed(spark):
    recs = explode_request_pages(text_df(spark, [
        '[{"unique_key":"a","created_date":"2024-05-07T00:00:00.000"},'
        '{"unique_key":"b","created_date":"2024-05-06T23:59:59.999"},'
        '{"unique_key":"c","created_date":"2024-05-10T12:00:00.000","latitude":"","closed_date":"x"}]']))
    rows = requests.project_records(recs)
    kept = requests.window_for_mode(rows, "incremental", "2024-05-10 09:00:00")
    assert sorted(r.unique_key for r in kept.collect()) == ["a", "c"]
    t = {r.unique_key: r for r in requests.typed_requests(rows).collect()}
    assert t["c"].latitude_d is None and t["c"].closed_at is None
    assert t["a"].created_at == dt.datetime(2024, 5, 7)
    with pytest.raises(ValueError):
        requests.window_for_mode(rows, "daily", "2024-05-10 09:00:00")


# --- weather ----------------------------------------------------------------------

DOC = {"name": "X", "coord": {"lat": 40.78, "lon": -73.97},
       "sys": {"country": "US", "sunrise": 1714558000, "sunset": 1714608000},
       "weather": [{"main": "Rain", "description": "light rain", "icon": "10d"}],
       "main": {"temp": 12, "feels_like": 11.2, "temp_min": 10.0, "temp_max": 14.1,
                "pressure": 1012, "humidity": 81},
       "wind": {"speed": 3.6, "deg": 200}, "clouds": {"all": 90}, "rain": {"1h": 0.3},
       "dt": 1714600000}


def variant(**changes):
    d = json.loads(json.dumps(DOC))
    for path, v in changes.items():
        node, *rest = path.split("__")
        if not rest:
            if v is ...:
                d.pop(node, None)
            else:
                d[node] = v
        else:
            if v is ...:
                d[node].pop(rest[0], None)
            else:
                d[node][rest[0]] = v
    return d


def flatten(spark, docs, on_error="fail"):
    parsed = parse_weather_docs(text_df(spark, docs, borough="Manhattan"))
    return weather.flatten(parsed, AT, on_error=on_error)


def test_weather_flatten_example(spark):
    r = flatten(spark, [DOC]).first()
    assert r.borough == "Manhattan" and r.city_name == "X" and r.country == "US"
    assert r.temp_celsius == 12.0 and isinstance(r.temp_celsius, float)   # int widened
    assert r.rain_1h_mm == 0.3 and r.snow_1h_mm is None and r.visibility_meters is None
    assert r.observation_timestamp == dt.datetime(2024, 5, 1, 21, 46, 40)
    assert r.weather_main == "Rain" and r._source == C.SOURCE_WEATHER
    assert len(flatten(spark, [DOC]).columns) == 25


def test_weather_numbers_keep_float_semantics(spark):
    r = flatten(spark, [variant(coord__lon=-0.0, main__temp="12.5")]).first()
    assert r.lon == 0.0 and str(r.lon) == "-0.0"      # sign of zero kept
    assert r.temp_celsius == 12.5                     # text-encoded number cast


def test_weather_optional_defaults(spark):
    r = flatten(spark, [variant(name=..., sys__country=..., wind__deg=..., main__temp=None)]).first()
    assert r.city_name == "" and r.country == "" and r.wind_direction_deg is None
    assert r.temp_celsius is None          # a present null leaf is NULL, not a failure


@pytest.mark.parametrize("change, reason", [
    ({"coord__lat": ...}, "coord.lat"),
    ({"weather": []}, "weather[0].main"),
    ({"main__humidity": ...}, "main.humidity"),
    ({"wind": ...}, "wind"),
    ({"rain": None}, "rain"),
    ({"dt": None}, "dt"),
    ({"sys__sunset": ...}, "sys.sunset"),
])
def test_weather_required_paths(spark, change, reason):
    bad = variant(**change)
    good, rejected = flatten(spark, [DOC, bad], on_error="quarantine")
    assert good.count() == 1
    assert rejected.first()["_issues"][0] == reason
    with pytest.raises(PySparkException):
        flatten(spark, [DOC, bad]).collect()


# --- survey -----------------------------------------------------------------------

SURVEY = [["NAME", "B01003_001E", "B19013_001E", "B17001_002E", "B25001_001E", "B08006_001E",
           "state", "county"],
          ["a", "1000", "70000", "125", "400", "600", "36", "061"],
          ["b", "0", "-666666666", "5", "x", None, "36", "999"]]


def survey_rows(spark, docs):
    return explode_census_docs(text_df(spark, docs)).withColumn("name", F.col("data")["NAME"])


def test_survey_example(spark):
    out = {r.name: r for r in census.clean(survey_rows(spark, [SURVEY]), AT, keep=["name"]).collect()}
    a, b = out["a"], out["b"]
    assert a.borough == "Manhattan" and a.poverty_rate_pct == 12.5 and a.survey_year == 2022
    assert a.median_household_income == 70000.0 and a.state_fips == "36"
    assert b.borough == "Unknown" and b.total_population == 0.0
    assert b.median_household_income is None and b.poverty_rate_pct is None
    assert b.total_housing_units is None and b.total_workers_commuting is None


def test_header_zip_short_side_and_last_duplicate(spark):
    doc = [["NAME", "county", "state", "county"], ["a", "061", "34", "005"], ["b", "047"]]
    rows = {r.name: r.data for r in survey_rows(spark, [doc]).collect()}
    assert rows["a"] == {"NAME": "a", "county": "005", "state": "34"}   # last duplicate wins
    assert rows["b"] == {"NAME": "b", "county": "047"}                  # zip stops at shorter
    cleaned = {r.name: r for r in census.clean(survey_rows(spark, [doc]), AT, keep=["name"]).collect()}
    assert cleaned["b"].state_fips == "36" and cleaned["a"].borough == "Bronx"


def test_header_only_and_county_filter(spark):
    assert survey_rows(spark, [[SURVEY[0]]]).count() == 0
    c = census.clean(survey_rows(spark, [SURVEY]), AT, keep=["name"])
    assert [r.name for r in census.filter_counties(c).collect()] == ["a"]
