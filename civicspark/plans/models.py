"""Models over the raw tables, registered as session views.

These are the analytics the feeds exist for, applied to the landed tables
themselves (``requests_raw``, ``weather_raw``, ``census_raw``):

* ``requests_latest``   one row per request, newest load wins (status and
                        closed date change between loads)
* ``requests_typed``    typed request times and coordinates
* ``census_dimension``  Type 2 demographic dimension: borough, versions by
                        survey year, unchanged years collapsed
* ``census_changes``    year-over-year change of the demographic measures
* ``census_density``    persons per housing unit
* ``requests_daily``    request volume per borough and local day
* ``weather_request_correlation``  per borough: request volume vs. daily mean
                        temperature, with the current demographics
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark.functions import scalars as X
from civicspark.operators import analytics, history, requests

MEASURES = list(C.SURVEY_VARIABLES.values()) + ["poverty_rate_pct"]
CITY_ZONE = "America/New_York"


def requests_latest(requests_raw: DataFrame) -> DataFrame:
    """Latest row per ``unique_key`` by load time.  Inside one load a closed row
    wins, then the later closing time.  Rows without a key stay separate."""
    return history.latest_request_rows(requests_raw)


def requests_typed(requests_raw: DataFrame) -> DataFrame:
    return requests.typed_requests(requests_latest(requests_raw))


def request_days(requests_raw: DataFrame) -> DataFrame:
    """Borough and creation time of each request: the volume models shuffle these columns and those
    that say which row is the latest, not the whole rows."""
    state = ["unique_key", "status", "closed_date", "_ingested_at", *history.FEED_ORDER]
    rows = requests_raw.select("borough", "created_date", *[c for c in state if c in requests_raw.columns])
    return requests_latest(rows).select("borough", X.iso_to_ntz("created_date").alias("created_at"))


def census_dimension(census_raw: DataFrame) -> DataFrame:
    """SCD2 on borough: a version starts in the first survey year whose
    measures differ (NULL-safe) from the previous year's; ``valid_to`` is the
    next version's first year.  The table has one row per borough and survey
    year, so a borough's window holds only its years: a plain window."""
    return history.scd2(census_raw, ["borough"], ["survey_year"], MEASURES, "survey_year",
                        skew_safe=False) \
        .withColumnsRenamed({"valid_from": "valid_from_year", "valid_to": "valid_to_year"})


def census_changes(census_raw: DataFrame) -> DataFrame:
    """Measures minus the previous survey year's, per borough (one row per
    borough and year, so a borough's window is its years)."""
    w = Window.partitionBy("borough").orderBy("survey_year")
    cols = [F.col(m) - F.lag(m).over(w) for m in MEASURES]
    return census_raw.select("borough", "survey_year",
                             *[c.alias(f"{m}_change") for c, m in zip(cols, MEASURES)])


def census_density(census_raw: DataFrame) -> DataFrame:
    """Density proxy of each borough and survey year: persons per housing unit; NULL without units."""
    return census_raw.select("borough", "survey_year", "total_population", "total_housing_units",
                             analytics.ratio("total_population", "total_housing_units", 4).alias("density"))


def requests_daily(requests_raw: DataFrame) -> DataFrame:
    """Request times are the city's local wall clock already: their date is the
    local day (no zone conversion)."""
    t = request_days(requests_raw)
    return (t.groupBy(X.normalise_borough("borough").alias("borough"),
                      F.to_date("created_at").alias("local_day"))
            .agg(F.count(F.lit(1)).alias("n_requests")))


def weather_request_correlation(requests_raw: DataFrame, weather_raw: DataFrame,
                                census_raw: DataFrame) -> DataFrame:
    current = census_dimension(census_raw).filter("is_current").select(
        "borough", "total_population", "poverty_rate_pct")
    # request times are local, observation times UTC: align on the local day
    return analytics.weather_vs_requests(request_days(requests_raw), weather_raw, current,
                                         obs_zone=CITY_ZONE)


def register_views(spark: SparkSession, requests_path: str, weather_path: str,
                   census_path: str) -> list[str]:
    """Register the raw tables and every model as session temporary views."""
    rq = spark.read.parquet(requests_path)
    wx = spark.read.parquet(weather_path)
    cs = spark.read.parquet(census_path)
    views = {
        "requests_raw": rq, "weather_raw": wx, "census_raw": cs,
        "requests_latest": requests_latest(rq),
        "requests_typed": requests_typed(rq),
        "census_dimension": census_dimension(cs),
        "census_changes": census_changes(cs),
        "census_density": census_density(cs),
        "requests_daily": requests_daily(rq),
        "weather_request_correlation": weather_request_correlation(rq, wx, cs),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
