"""The three feed loads, end to end: landing directory -> raw table.

Each is one lazy plan and one write job (plus the small checks the load
semantics require); nothing is collected to the driver.

* ``load_requests``  pages -> look-back window of the mode -> 15 columns with
                     missing-key defaults -> lineage -> append
* ``load_weather``   one document per borough (landing partitioned by
                     ``borough=``) -> required-path check -> 25 columns -> append
* ``load_survey``    header-plus-rows documents -> typed, cleaned rows ->
                     keyed upsert on (borough, survey_year)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import census, requests, weather
from civicspark.operators.quality import reject_over_length
from civicspark.sinks import tables as sinks
from civicspark.sources.landing import (explode_census_docs, explode_request_pages,
                                        parse_weather_docs, read_payloads)


def request_rows(spark: SparkSession, landing_dir: str, mode: str, as_of, ingested_at) -> DataFrame:
    X.validate_mode(mode)
    recs = explode_request_pages(read_payloads(spark, landing_dir).select("value"))
    rows = requests.window_for_mode(requests.project_records(recs), mode, as_of)
    rows = requests.add_lineage(rows, ingested_at, C.SOURCE_REQUESTS, mode)
    return rows.select(*[c.name for c in schemas.REQUESTS_RAW])


DAY_PARTITION = "_created_day"


def load_requests(spark: SparkSession, landing_dir: str, table_path: str, mode: str = C.DEFAULT_MODE,
                  as_of=None, ingested_at=None, check_lengths: bool = True,
                  partition_by_day: bool = False) -> int:
    """Append the window of ``mode`` to the requests table; returns rows loaded
    (0 and no write when nothing qualifies).

    ``partition_by_day`` adds ``_created_day`` (date of ``created_date``) and
    partitions the table by it, so later look-back reads prune to the days of
    their window."""
    as_of = as_of if as_of is not None else X.utc_now()
    ingested_at = ingested_at if ingested_at is not None else as_of
    rows = request_rows(spark, landing_dir, mode, as_of, ingested_at)
    if check_lengths:
        rows = reject_over_length(rows, schemas.max_lengths(schemas.REQUESTS_RAW))
    part = None
    if partition_by_day:
        rows = rows.withColumn(DAY_PARTITION, F.to_date(X.iso_to_ntz("created_date")))
        part = [DAY_PARTITION]
    # files of at most ten insert batches (50,000 rows)
    return sinks.load_feed(rows, table_path, "requests_raw", partition_by=part,
                           max_records_per_file=C.INSERT_BATCH_SIZE * 10)


def weather_rows(spark: SparkSession, landing_dir: str, ingested_at, on_error: str = "fail"):
    docs = read_payloads(spark, landing_dir)
    if "borough" not in docs.columns:
        raise ValueError("weather landing must be partitioned by borough=<name>")
    return weather.flatten(parse_weather_docs(docs.select("borough", "value")), ingested_at,
                           on_error=on_error)


def load_weather(spark: SparkSession, landing_dir: str, table_path: str, ingested_at=None) -> int:
    """Append one row per landed document; any document missing a required
    path fails the whole load (nothing is written)."""
    ingested_at = ingested_at if ingested_at is not None else X.utc_now()
    return sinks.append(weather_rows(spark, landing_dir, ingested_at), table_path)


def survey_rows(spark: SparkSession, landing_dir: str, ingested_at,
                survey_year: int = C.SURVEY_YEAR) -> DataFrame:
    rows = explode_census_docs(read_payloads(spark, landing_dir).select("value"))
    return census.clean(rows, ingested_at, survey_year)


def load_survey(spark: SparkSession, landing_dir: str, table_path: str, ingested_at=None,
                survey_year: int = C.SURVEY_YEAR) -> int:
    """Upsert the survey rows on (borough, survey_year); returns staged rows.
    Only the touched ``survey_year`` partitions are rewritten."""
    ingested_at = ingested_at if ingested_at is not None else X.utc_now()
    rows = survey_rows(spark, landing_dir, ingested_at, survey_year)
    if rows.isEmpty():
        return 0
    return sinks.upsert(rows, table_path, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE,
                        partition_col="survey_year")
