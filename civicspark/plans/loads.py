"""The three loads into versioned tables: each landed file once, each payload accounted for.

A run takes the files its table's ledger does not hold, parses them once into
rows and rejects (``operators.outcomes``), and publishes rows, rejects and the
files it consumed as one version.  A run without new files, or one that dies,
changes nothing.  Tables are created on first use with their declared columns.

``requests_raw`` keeps, behind its declared columns, the creation day as
partition and the feed order (time of the file, place in the page), which
decides between two states of a request that come with one load.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import census, outcomes, requests
from civicspark.session import shared_path
from civicspark.sinks import versions
from civicspark.sources import arrivals

DAY_PARTITION = "_created_day"
REJECTS = "rejects"
ROWS_PER_FILE = 500_000


@dataclass(frozen=True)
class Loaded:
    version: int
    rows: int = 0
    rejected: int = 0
    files: int = 0
    reasons: dict = field(default_factory=dict)
    missing_boroughs: tuple = ()


def requests_schema() -> T.StructType:
    return T.StructType([*schemas.struct_type(schemas.REQUESTS_RAW).fields,
                         T.StructField("_file_time", T.TimestampType()), T.StructField("_file", T.StringType()),
                         T.StructField("_position", T.IntegerType()), T.StructField(DAY_PARTITION, T.DateType())])


def _staged(found: DataFrame) -> tuple[DataFrame, dict]:
    """Outcomes written once, with their counts observed during that write."""
    seen = Observation("outcomes")
    path = shared_path(found.sparkSession, "outcomes")
    found.observe(seen, *outcomes.counted()).write.parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path), dict(seen.get)


def _publish(found: DataFrame, rows, files: DataFrame, path: str, source: str, ingested_at, base, write) -> Loaded:
    staged, counts = _staged(found)
    rejected = int(counts["rejected"])
    beside = {arrivals.LEDGER: files}
    if rejected:
        beside[REJECTS] = outcomes.rejects(staged, source, ingested_at)
    info = {"rejected": rejected, "files": files.count()}
    done = write(rows(staged.filter(F.col("reason").isNull())), info, beside)
    return Loaded(done.number, int(done.info.get("rows", 0)), rejected, info["files"],
                  {k: int(counts[k]) for k in outcomes.KINDS if counts[k]})


def _new_files(spark, landing_dir: str, table_path: str, since, base, again: bool) -> DataFrame:
    """The arrivals, written once: read, counted and recorded from one listing."""
    path = shared_path(spark, "arrivals")
    arrivals.arrivals(spark, landing_dir, table_path, since, base, again).write.parquet(path)
    return spark.read.schema(versions.struct(spark, arrivals.ARRIVED)).parquet(path)


def load_requests(spark: SparkSession, landing_dir: str, table_path: str, mode: str = C.DEFAULT_MODE, as_of=None,
                  ingested_at=None, since: str | None = None, again: bool = False) -> Loaded:
    """Appends the mode's window of the new pages.  ``again`` reads all landed files, for a back-fill."""
    X.validate_mode(mode)
    as_of = as_of if as_of is not None else X.utc_now()
    ingested_at = ingested_at if ingested_at is not None else as_of
    schema = requests_schema()
    base = versions.create(spark, table_path, schema, C.COMMENT_REQUESTS)
    files = _new_files(spark, landing_dir, table_path, since, base, again)
    if files.isEmpty():
        return Loaded(base.number)
    found = outcomes.request_outcomes(arrivals.payloads(spark, landing_dir, files), ingested_at, mode)

    def rows(good: DataFrame) -> DataFrame:
        window = requests.window_for_mode(good, mode, as_of)
        return window.withColumns({"_file_time": F.col("modified"), "_file": F.col("path"), "_position": F.col("position"),
                                   DAY_PARTITION: F.to_date(X.iso_to_ntz("created_date"))}).select(*schema.names)

    def write(r: DataFrame, info: dict, beside: dict):
        # a day's rows lie together, in files of about ROWS_PER_FILE whatever the number of pages
        fullest = r.groupBy(DAY_PARTITION).count().agg(F.max("count")).first()[0] or 0
        slices = F.pmod(F.xxhash64("unique_key", "_file", "_position"), F.lit(1 + fullest // ROWS_PER_FILE))
        return versions.append(r.repartition(F.col(DAY_PARTITION), slices), table_path, DAY_PARTITION, ["unique_key"], info=info,
                               base=base, beside=beside, max_records_per_file=2 * ROWS_PER_FILE)

    return _publish(found, rows, files, table_path, C.SOURCE_REQUESTS, ingested_at, base, write)


def load_weather(spark: SparkSession, landing_dir: str, table_path: str, ingested_at=None, since: str | None = None,
                 on_error: str = "fail", require_all: bool = False) -> Loaded:
    """Appends one row per new document.  ``on_error='fail'``: a rejected document fails the load, as the
    feed's rule is; ``'quarantine'`` loads the rest.  Boroughs of the lookup without a document are
    reported, and with ``require_all`` fail the load."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    ingested_at = ingested_at if ingested_at is not None else X.utc_now()
    schema = schemas.struct_type(schemas.WEATHER_RAW)
    base = versions.create(spark, table_path, schema, C.COMMENT_WEATHER)
    files = _new_files(spark, landing_dir, table_path, since, base, False)
    if files.isEmpty():
        return Loaded(base.number)
    texts = arrivals.payloads(spark, landing_dir, files)
    if "borough" not in texts.columns:
        raise ValueError("weather landing must be partitioned by borough=<name>")
    missing: list[str] = []

    def write(rows: DataFrame, info: dict, beside: dict):
        if on_error == "fail" and info["rejected"]:
            raise ValueError(f"{info['rejected']} weather document(s) rejected; nothing was loaded")
        here = {r["borough"] for r in rows.select("borough").distinct().filter(
            F.col("borough").isin([b for b, _, _ in C.BOROUGH_CENTRES])).collect()}
        missing.extend(b for b, _, _ in C.BOROUGH_CENTRES if b not in here)
        if require_all and missing:
            raise ValueError(f"no observation for {', '.join(missing)}; nothing was loaded")
        return versions.append(rows, table_path, keys=["borough"], info={**info, "missing_boroughs": missing}, base=base,
                               beside=beside)

    done = _publish(outcomes.weather_outcomes(texts, ingested_at), lambda good: good.select(*schema.names), files,
                    table_path, C.SOURCE_WEATHER, ingested_at, base, write)
    return Loaded(done.version, done.rows, done.rejected, done.files, done.reasons, tuple(missing))


def load_survey(spark: SparkSession, landing_dir: str, table_path: str, ingested_at=None, since: str | None = None,
                survey_year: int = C.SURVEY_YEAR, on_error: str = "fail") -> Loaded:
    """Merges the wanted counties' rows of the new documents on (borough, survey_year); only files
    that hold a merged key are rewritten."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    ingested_at = ingested_at if ingested_at is not None else X.utc_now()
    schema = schemas.struct_type(schemas.CENSUS_RAW)
    base = versions.create(spark, table_path, schema, C.COMMENT_CENSUS)
    files = _new_files(spark, landing_dir, table_path, since, base, False)
    if files.isEmpty():
        return Loaded(base.number)

    def write(rows: DataFrame, info: dict, beside: dict):
        if on_error == "fail" and info["rejected"]:
            raise ValueError(f"{info['rejected']} survey payload(s) rejected; nothing was loaded")
        return versions.upsert(rows, table_path, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE, "survey_year", info=info,
                               base=base, beside=beside)

    return _publish(outcomes.survey_outcomes(arrivals.payloads(spark, landing_dir, files), ingested_at, survey_year),
                    lambda good: census.filter_counties(good).select(*schema.names), files, table_path, C.SOURCE_CENSUS,
                    ingested_at, base, write)


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """Dead letters of all loads."""
    return versions.read(spark, table_path, versions.struct(spark, outcomes.REJECT), kind=REJECTS)
