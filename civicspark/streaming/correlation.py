"""Weather and survey streams, and daily weather joined with daily request volume.

Both feeds are reduced to one row per borough and day before they meet, in
watermarked one-day windows; the join is an outer join of two streams on borough
and window.  A day is final, and its state is dropped, once the watermarks of both
feeds have passed it, so state holds the open days only.  Days without an
observation come out with NULL, as in the batch query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import census, outcomes, weather
from civicspark.sinks import versions
from civicspark.sources.landing import parse_weather_docs
from civicspark.streaming.changes import _stream_id
from civicspark.streaming.feeds import LOOKBACK


def weather_stream(spark: SparkSession, landing_dir: str, ingested_at=None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Observation files landing in ``borough=<name>`` folders -> ``weather_raw`` rows."""
    reader = spark.readStream.schema("value string, borough string").format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    at = ingested_at if ingested_at is not None else X.utc_now()
    return weather.flatten(parse_weather_docs(reader.load(landing_dir).select("borough", "value")), at)


def survey_upserts(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str, ingested_at=None,
                   survey_year: int = C.SURVEY_YEAR, available_now: bool = True) -> StreamingQuery:
    """Survey documents as they land, merged into the versioned table on (borough, survey_year); the wanted
    counties only.  A payload that is no survey stops the stream, as it fails the load."""
    at = ingested_at if ingested_at is not None else X.utc_now()
    schema = schemas.struct_type(schemas.CENSUS_RAW)
    docs = (spark.readStream.format("text").option("wholetext", "true").load(landing_dir)
            .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value"))

    def merge(batch: DataFrame, number: int) -> None:
        session, stream = batch.sparkSession, _stream_id(batch.sparkSession, checkpoint)
        base = versions.create(session, table_path, schema, C.COMMENT_CENSUS)
        if base.info.get(versions.BATCHES, {}).get(stream, -1) >= number:
            return
        found = outcomes.survey_outcomes(batch, at, survey_year)
        bad = found.filter(F.col("reason").isNotNull()).select("path", "reason").head(1)
        if bad:
            raise ValueError(f"{bad[0]['path']}: {bad[0]['reason']}")
        # of documents for one county in one batch the latest file counts
        newest = found.groupBy(*schemas.CENSUS_KEY).agg(F.max_by(F.struct(*schema.names), F.struct("modified", "path", "position"))
                                                        .alias("r")).select("r.*")
        versions.upsert(census.filter_counties(newest).select(*schema.names), table_path, schemas.CENSUS_KEY,
                        schemas.CENSUS_UPDATE, "survey_year", base=base, info={versions.BATCHES: {stream: number}})

    w = docs.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _wall_time(ntz: Column) -> Column:
    """A zone-less time as the TIMESTAMP that watermarks need, with the same clock in UTC."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", X.epoch_ntz(), ntz))


def daily_correlation_rows(requests: DataFrame, observations: DataFrame, delay: str = LOOKBACK,
                           obs_zone: str | None = None) -> DataFrame:
    """``day_start, borough, n_req, mean_temp`` of every final day with requests, from two streams of
    ``requests_raw`` and ``weather_raw`` rows.  ``obs_zone``: observation times (UTC) go by that zone's day."""
    seen = F.col("observation_timestamp")
    if obs_zone:
        seen = F.convert_timezone(F.lit("UTC"), F.lit(obs_zone), seen)
    day = F.window("t", "1 day").alias("w")
    req = (requests.select(_wall_time(X.iso_to_ntz("created_date")).alias("t"), X.normalise_borough(F.col("borough")).alias("borough"))
           .withWatermark("t", delay).groupBy(day, "borough").agg(F.count(F.lit(1)).alias("n_req")))
    obs = (observations.select(_wall_time(seen).alias("t"), X.normalise_borough(F.col("borough")).alias("borough"), "temp_celsius")
           .withWatermark("t", delay).groupBy(day, "borough").agg(F.avg("temp_celsius").alias("mean_temp"))
           .select(F.col("w").alias("obs_w"), F.col("borough").alias("obs_borough"), "mean_temp"))
    both = req.join(obs, (F.col("w") == F.col("obs_w")) & (F.col("borough") == F.col("obs_borough")), "left_outer")
    return both.select(F.col("w.start").alias("day_start"), "borough", "n_req", "mean_temp")


def correlation(daily: DataFrame) -> DataFrame:
    """Per borough over the final days: days, requests and the correlation, as the batch model has them."""
    return daily.groupBy("borough").agg(F.count(F.lit(1)).alias("n_days"), F.sum("n_req").alias("requests"),
                                        F.round(F.corr(F.col("n_req").cast("double"), "mean_temp"), 6).alias("corr_temp"))
