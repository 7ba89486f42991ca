"""Structured Streaming forms of the request feed.

* ``request_stream``      landing directory of page files -> parsed rows (file source)
* ``land_requests``       append the rows to the raw table; ``availableNow`` runs
                          drain what has landed since the last run (checkpointed)
* ``dedupe_redeliveries`` drop exact re-deliveries of a key within the look-back
                          (state bounded by the watermark)
* ``upsert_latest_requests`` keep one row per request, the newest load winning,
                          via ``foreachBatch`` + the batch upsert
* ``daily_volume_stream`` tumbling one-day counts per borough, emitted once the
                          watermark passes the day
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import history, requests
from civicspark.sinks import tables as sinks
from civicspark.sources.landing import explode_request_pages

LOOKBACK = f"{C.INCREMENTAL_DAYS} days"


def request_stream(spark: SparkSession, landing_dir: str, mode: str = C.DEFAULT_MODE,
                   ingested_at=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Page files landing in ``landing_dir`` -> ``requests_raw`` rows.
    ``_ingested_at`` is the micro-batch time unless a fixed value is given."""
    X.validate_mode(mode)
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.load(landing_dir)
    rows = requests.project_records(explode_request_pages(pages))
    at = X.as_of_literal(ingested_at) if ingested_at is not None else \
        X.utc_now()
    rows = rows.withColumns({"_ingested_at": at, "_ingestion_mode": F.lit(mode),
                             "_source": F.lit(C.SOURCE_REQUESTS)})
    return rows.select(*[c.name for c in schemas.REQUESTS_RAW])


def land_requests(rows: DataFrame, table_path: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Append streamed rows to the Parquet table; the checkpoint makes each
    file land exactly once across runs and restarts."""
    w = rows.writeStream.format("parquet").option("path", table_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def event_time(rows: DataFrame, text_col: str = "created_date", out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ); feed times are UTC wall clock."""
    micros = F.timestamp_diff("MICROSECOND", X.epoch_ntz(), X.iso_to_ntz(text_col))
    return rows.withColumn(out, F.timestamp_micros(micros))


def dedupe_redeliveries(rows: DataFrame, key: str = "unique_key", delay: str = LOOKBACK,
                        time_col: str = "event_time") -> DataFrame:
    """Drop repeated deliveries of a key within ``delay`` of event time.  Keeps
    the first copy: use it for identical re-deliveries, not for updates."""
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


DAY_PARTITION = "_created_day"


def _new_keyless(rows: DataFrame, cols: list[str], table_path: str) -> DataFrame:
    """Rows without a key, once each, that the table's rows without a key do not hold: compared by all
    feed columns (null-safe), on the days the rows touch."""
    same = [c for c in cols if c not in ("_ingested_at", "_ingestion_mode", "_source")]
    rows = rows.select(*cols).dropDuplicates(same)
    stored = sinks.read_table_or_empty(rows.sparkSession, table_path, rows.schema).filter("unique_key IS NULL")
    if DAY_PARTITION in cols:
        days = rows.select(F.col(DAY_PARTITION).alias("_day")).distinct()
        stored = stored.join(days, F.col(DAY_PARTITION).eqNullSafe(F.col("_day")), "left_semi")
    stored = stored.select(*[F.col(c).alias(f"_s_{c}") for c in same])
    return rows.join(stored, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in same], "left_anti")


def upsert_latest_requests(rows: DataFrame, table_path: str, checkpoint: str,
                           available_now: bool = True, partition_by_day: bool = True) -> StreamingQuery:
    """Per micro-batch: newest row per request (by load time, then closed before
    open), merged into the table on ``unique_key``.  A row without a key (NULL or
    '') names no request: it is kept unless the days it touches hold the same feed
    columns already.  So replaying a batch after a failure changes nothing.

    With ``partition_by_day`` the table is partitioned by the request's
    creation day (``_created_day``): a batch reads and rewrites only the days it
    touches (a few, given the look-back) instead of the whole table, and so
    cannot find a request whose day changed.  ``streaming.changes`` finds it, and
    writes each batch once instead of merging it into the days."""
    if partition_by_day:
        rows = rows.withColumn(DAY_PARTITION, F.to_date(X.iso_to_ntz("created_date")))
    cols = rows.columns
    updates = [c for c in cols if c not in ("unique_key", DAY_PARTITION)]

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.withColumn("unique_key", F.nullif("unique_key", F.lit("")))
        latest = history.latest_request_rows(batch) if "closed_date" in cols else history.latest_by_key(
            batch, ["unique_key"], ["_ingested_at", "status"])
        named = latest.filter("unique_key IS NOT NULL").select(*cols)
        sinks.upsert(named.unionByName(_new_keyless(latest.filter("unique_key IS NULL"), cols, table_path)),
                     table_path, ["unique_key"], updates, partition_col=DAY_PARTITION if partition_by_day else None)

    w = rows.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def daily_volume_stream(rows: DataFrame, delay: str = LOOKBACK, time_col: str = "event_time",
                        borough_col: str = "borough") -> DataFrame:
    """Tumbling one-day request counts per borough; a day is emitted (append
    mode) once the watermark has passed its end, so late rows within
    ``delay`` still count."""
    return (rows.withWatermark(time_col, delay)
            .groupBy(F.window(time_col, "1 day").alias("w"),
                     X.normalise_borough(F.col(borough_col)).alias("borough"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("day_start"), "borough", "n"))
