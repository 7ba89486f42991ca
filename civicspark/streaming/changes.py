"""Latest state of each request from a stream, merged when read.

Each micro-batch appends its newest row per request to a change log beside the
table (one write, one publish); a reader takes, per request, the newer of the
stored row and the log's; ``compact`` moves the log into the table, rewriting only
files that hold a changed request.  So a batch costs what it brings, not what the
days it touches hold.

* A batch is published once: the version carries the stream's last batch number,
  and a batch that is replayed after a failure finds itself there.
* A row without a key is known by a hash of its feed columns, so delivering it
  again changes nothing either, under whatever stream.
* A request that changes its day leaves no row behind: the log is read by key, and
  compaction finds the old row through the key index.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from civicspark import constants as C
from civicspark.functions import scalars as X
from civicspark.operators.history import FEED_ORDER, latest_by_key
from civicspark.sinks import versions

KEY, DAY, CHANGES = "_row_key", "_created_day", "changes"
COMPACT_EVERY = 20            # batches


def table_schema(columns: T.StructType) -> T.StructType:
    return T.StructType([*columns.fields, T.StructField(KEY, T.StringType()), T.StructField(DAY, T.DateType())])


def keyed(rows: DataFrame) -> DataFrame:
    """Adds the row's key and creation day."""
    content = F.sha2(F.to_json(F.struct(*[c for c in C.REQUEST_COLUMNS if c in rows.columns])), 256)
    key = F.when(F.coalesce("unique_key", F.lit("")) != "", F.concat(F.lit("key:"), F.col("unique_key")))
    return rows.withColumns({KEY: F.coalesce(key, F.concat(F.lit("content:"), content)),
                             DAY: F.to_date(X.iso_to_ntz("created_date"))})


def _order(columns: list[str]) -> list[str]:
    """Newer means: a later load, then the feed order if the rows have it, then closed before open."""
    return ["_ingested_at", *[c for c in FEED_ORDER if c in columns], "closed_date", "status"]


def newest(rows: DataFrame) -> DataFrame:
    return latest_by_key(rows, [KEY], _order(rows.columns)).select(*rows.columns)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(versions._read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def append_batch(batch: DataFrame, table_path: str, stream: str, number: int) -> versions.Version:
    """Publishes a batch's newest rows as changes, unless that batch is published already."""
    spark = batch.sparkSession
    rows = keyed(batch)
    base = versions.create(spark, table_path, rows.schema)
    if base.info.get(versions.BATCHES, {}).get(stream, -1) >= number:
        return base
    return versions.append(rows.limit(0), table_path, DAY, [KEY], base=base, beside={CHANGES: newest(rows)},
                           info={"operation": "changes", versions.BATCHES: {stream: number},
                                 "pending": base.info.get("pending", 0) + 1})


def log_latest_requests(rows: DataFrame, table_path: str, checkpoint: str, available_now: bool = True,
                        compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Streamed requests to the change log of ``table_path``, compacted every so many batches."""
    def publish(batch: DataFrame, number: int) -> None:
        done = append_batch(batch, table_path, _stream_id(batch.sparkSession, checkpoint), number)
        if compact_every and done.info.get("pending", 0) >= compact_every:
            compact(batch.sparkSession, table_path)

    w = rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _log(spark: SparkSession, table_path: str, schema: T.StructType, version: versions.Version) -> DataFrame:
    """The newest logged row of each request."""
    return newest(versions.read(spark, table_path, schema, version, CHANGES))


def _older(base: DataFrame, log: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows beside the log's row of their key, and whether the stored one is as new."""
    new = log.select(F.col(KEY).alias("_k"), F.struct(*log.columns).alias("_new"))
    joined = base.select(KEY, F.struct(*base.columns).alias("_old")).join(new, F.col(KEY) == F.col("_k"), "left")
    stays = F.col("_new").isNull() | (F.struct(*[F.col("_old")[c] for c in order]) >= F.struct(*[F.col("_new")[c] for c in order]))
    return joined.withColumn("_stays", stays)


def read_latest(spark: SparkSession, table_path: str, version: versions.Version | None = None) -> DataFrame:
    """One row per request: the stored row or the logged one, whichever is newer.  The join is by key;
    Spark broadcasts the log while it is small and shuffles otherwise."""
    version = version or versions.latest(spark, table_path)
    schema = versions.declared_schema(spark, table_path)
    base, log = versions.read(spark, table_path, schema, version), _log(spark, table_path, schema, version)
    pairs = _older(base, log, _order(schema.names))
    stored = pairs.select(F.when(F.col("_stays"), F.col("_old")).otherwise(F.col("_new")).alias("r")).select("r.*")
    return stored.unionByName(log.join(base.select(KEY), KEY, "left_anti").select(*schema.names))


def compact(spark: SparkSession, table_path: str) -> versions.Version:
    """Moves the log into the table.  Conflicts with a batch that is published meanwhile: then try again."""
    version = versions.latest(spark, table_path)
    schema = versions.declared_schema(spark, table_path)
    log = _log(spark, table_path, schema, version)
    base = versions.read(spark, table_path, schema, version)
    keeps = _older(base.join(log.select(KEY), KEY, "left_semi"), log, _order(schema.names)).filter("_stays").select(KEY)
    return versions.replace_keys(log.join(keeps, KEY, "left_anti").select(*schema.names), table_path, [KEY], DAY, index=True,
                                 base=version, drop=(CHANGES,), info={"operation": "compact", "pending": 0})
