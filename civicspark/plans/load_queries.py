"""Registered queries of the versioned loads, with the SQL that states their rows.

They run real loads: landing files written from the shared tables, several runs,
tables read back at their newest version.  All of it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import history, keyset, outcomes
from civicspark.plans import adapters as A
from civicspark.plans import catalog, loads, models, oracle
from civicspark.session import shared_path
from civicspark.sinks import versions
from civicspark.sources import arrivals
from civicspark.streaming import changes

LATE_DAYS = 10              # the newest days land in a second delivery


# --- landing files ------------------------------------------------------------------------

def _land_pages(pages: DataFrame, folder: str, mode: str = "append") -> None:
    """One file per row: ``value`` (the page) in ``load_date=`` folders.  Tasks move their files there
    themselves, side by side; the folder is read after the write has ended."""
    (pages.select("value", arrivals.DAY).write.partitionBy(arrivals.DAY).option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode(mode).text(folder))


def _day_pages(records: DataFrame, rows_per_page: int = A.ROWS_PER_PAGE) -> DataFrame:
    """Pages of one day's records each."""
    page = (F.col("event_id") / F.lit(rows_per_page)).cast("long")
    return (records.groupBy(F.to_date("ts").alias(arrivals.DAY), page.alias("page_no"))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json("record")), ","), F.lit("]")).alias("value")))


def _two_deliveries(spark, sf) -> str:
    """The requests table after three runs: over the older days, over the newer ones, over nothing new."""
    records = catalog.landing_view(spark, sf, "request_records")
    newest = records.agg(F.max("ts").alias("ts"), F.date_sub(F.max(F.to_date("ts")), LATE_DAYS).alias("cut")).first()
    landing, table = shared_path(spark, "landing"), shared_path(spark, "requests_versions")
    late = F.to_date("ts") >= F.lit(newest["cut"])
    for part, at in ((records.filter(~late), A.EARLIER_INGESTED_AT), (records.filter(late), A.FIXED_INGESTED_AT)):
        _land_pages(_day_pages(part), landing)
        loads.load_requests(spark, landing, table, "historical", as_of=newest["ts"], ingested_at=at)
    loads.load_requests(spark, landing, table, "historical", as_of=newest["ts"], ingested_at=A.FIXED_INGESTED_AT)
    return table


def incremental_landing(spark, sf):
    """Each landed page once, over three runs."""
    return versions.read(spark, _two_deliveries(spark, sf)).select(*[c.name for c in schemas.REQUESTS_RAW], "_created_day")


def load_history(spark, sf):
    """What each version of the table did, from its own record."""
    return versions.history(spark, _two_deliveries(spark, sf)).select("version", "operation", "rows", "rejected")


def load_chunks(spark, sf):
    """Days that each of the loads wrote, with the rows loaded so far, from the manifests of the table."""
    return versions.chunks(spark, _two_deliveries(spark, sf)).select(
        "version", "chunk_no", F.col("part").alias("created_day"), "rows", "first_key", "last_key", "total_rows", "is_last")


# --- outcomes -----------------------------------------------------------------------------

def landing_outcomes(spark, sf):
    """Outcomes of whole, cut, empty and partly broken payloads of the three feeds, by reason."""
    text = lambda df: df.withColumns({"path": F.lit("x"), "modified": F.lit(None).cast("timestamp")})
    records = catalog.landing_view(spark, sf, "request_records")
    p5 = F.pmod("page_no", F.lit(5))
    pages = A.request_pages(records).withColumn("value", F.when(p5 == 1, F.expr("left(value, length(value) - 1)"))
                                                .when(p5 == 2, F.lit(""))
                                                .when(p5 == 3, F.concat(F.lit("[7,null,"), F.expr("substring(value, 2)")))
                                                .otherwise(F.col("value")))
    events, region = catalog._t(spark, sf, "events"), catalog._t(spark, sf, "region")
    r11 = F.pmod("event_id", F.lit(11))
    docs = A.weather_docs(events, region, broken=True).withColumn(
        "value", F.when(r11 == 1, F.lit(" \n")).when(r11 == 2, F.concat(F.lit("["), "value", F.lit("]")))
        .when(r11 == 3, F.regexp_replace("value", '"temp":[^,]*,', '"temp":"warm",'))
        .when(r11 == 4, F.regexp_replace(F.regexp_replace("value", '"name":"[^"]*",', ""), r"^\{", '{"name":"' + "n" * 101 + '",')).otherwise(F.col("value")))
    c3 = F.pmod("nation", F.lit(3))
    surveys = A.survey_docs(catalog._t(spark, sf, "customer")).withColumn(
        "value", F.when(c3 == 1, F.lit("[]")).when(c3 == 2, F.expr("left(value, length(value) - 2)")).otherwise(F.col("value")))
    at = A.FIXED_INGESTED_AT
    found = [(C.SOURCE_REQUESTS, outcomes.request_outcomes(text(pages), at, "historical")),
             (C.SOURCE_WEATHER, outcomes.weather_outcomes(text(docs), at)),
             (C.SOURCE_CENSUS, outcomes.survey_outcomes(text(surveys), at))]
    every = None
    for source, rows in found:
        n = rows.groupBy(F.coalesce("reason", F.lit("loaded")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
        n = n.select(F.lit(source).alias("source"), "reason", "n")
        every = n if every is None else every.unionByName(n)
    return every


# --- upserts ------------------------------------------------------------------------------

STATE = T.StructType([T.StructField("unique_key", T.StringType()), T.StructField("status", T.StringType()),
                      T.StructField("_created_day", T.DateType()), T.StructField("_ingested_at", T.TimestampNTZType())])


def requests_upsert(spark, sf):
    """Requests by creation day, then a load in which some change their day, some lose it, some are new
    and some have no key."""
    e = catalog._t(spark, sf, "events").select("event_id", "ts", "event_type")
    r9, day = F.pmod("event_id", F.lit(9)), F.to_date("ts")
    first = e.select(F.col("event_id").cast("string").alias("unique_key"), F.lit("Open").alias("status"),
                     F.when(F.pmod("event_id", F.lit(50)) != 0, day).alias("_created_day"),
                     X.as_of_literal(A.EARLIER_INGESTED_AT).alias("_ingested_at"))
    key = F.when(r9 == 6, F.concat(F.lit("N"), F.col("event_id").cast("string"))).when(r9 != 8, F.col("event_id").cast("string"))
    then = F.when(r9 == 0, F.date_add(day, 1)).when(r9 != 3, day)
    second = e.filter(r9.isin(0, 3, 6, 8)).select(key.alias("unique_key"), F.col("event_type").alias("status"),
                                                  then.alias("_created_day"),
                                                  X.as_of_literal(A.FIXED_INGESTED_AT).alias("_ingested_at"))
    path, names = shared_path(spark, "requests_by_day"), STATE.names
    versions.append(first.select(*names), path, "_created_day", ["unique_key"], index=True)
    versions.upsert(second.select(*names), path, ["unique_key"], names[1:], "_created_day", index=True)
    return versions.read(spark, path, STATE)


def census_merge_files(spark, sf):
    """The survey merge on a versioned table, by the full outer join, in files that hold a key."""
    a = catalog._order_demographics(spark, sf)
    schema = schemas.struct_type(schemas.CENSUS_RAW)
    path = shared_path(spark, "census_versions")
    versions.append(a.filter("side = 0").select(*schema.names), path, "survey_year", schemas.CENSUS_KEY)
    versions.upsert(a.filter("side = 1").select(*schema.names), path, schemas.CENSUS_KEY, schemas.CENSUS_UPDATE,
                    "survey_year", broadcast_rows=0)
    return versions.read(spark, path, schema)


def requests_feed_order(spark, sf):
    """Two or three states of each request in one load; the last place in the feed stands."""
    e = catalog._t(spark, sf, "events").select("event_id", "ts")
    opened, closed = (e.withColumn("state", F.lit(s)) for s in ("Open", "Closed"))
    odd = F.pmod("event_id", F.lit(2)) == 1
    nth = F.when(odd, F.when(F.col("state") == "Open", 0).otherwise(1)).otherwise(F.when(F.col("state") == "Open", 1).otherwise(0))
    record = F.create_map(F.lit("unique_key"), F.col("event_id").cast("string"), F.lit("created_date"), X.ntz_to_iso_ms("ts"),
                          F.lit("status"), F.col("state"), F.lit("closed_date"),
                          F.when(F.col("state") == "Closed", X.ntz_to_iso_ms("ts")).otherwise(F.lit("")))
    page = (F.col("event_id") / F.lit(A.ROWS_PER_PAGE)).cast("long")
    pages = (opened.unionByName(closed).select("ts", page.alias("page_no"), nth.alias("nth"), "event_id", record.alias("record"))
             .groupBy(F.to_date("ts").alias(arrivals.DAY), "page_no")
             .agg(F.sort_array(F.collect_list(F.struct("nth", "event_id", F.to_json("record").alias("r")))).alias("rs"))
             .select(arrivals.DAY, F.concat(F.lit("["), F.array_join(F.col("rs.r"), ","), F.lit("]")).alias("value")))
    again = _day_pages(e.filter("event_id % 3 = 0").withColumn("state", F.lit("Reopened")).select("event_id", "ts", record.alias("record")))
    landing, table = shared_path(spark, "landing"), shared_path(spark, "requests_order")
    _land_pages(pages, landing)
    _land_pages(again, landing)                              # later files
    newest = e.agg(F.max("ts")).first()[0]
    loads.load_requests(spark, landing, table, "historical", as_of=newest, ingested_at=A.FIXED_INGESTED_AT)
    return history.latest_request_rows(versions.read(spark, table)).select("unique_key", "status", "closed_date")


def requests_changes(spark, sf):
    """Three batches of a stream, read by merging the change log; one compaction in between.  Some requests
    change their day, some rows have no key and come twice."""
    e = catalog._t(spark, sf, "events").select("event_id", "ts")
    r9 = F.pmod("event_id", F.lit(9))
    table = shared_path(spark, "requests_changes")

    def batch(rows, number, status, at, days=0):
        b = rows.select(F.when(r9 != 8, F.col("event_id").cast("string")).alias("unique_key"),
                        X.ntz_to_iso_ms(F.col("ts") + F.expr(f"INTERVAL {days} DAYS")).alias("created_date"),
                        F.lit("").alias("closed_date"), F.col("event_id").cast("string").alias("descriptor"),
                        F.lit(status).alias("status"), X.as_of_literal(at).alias("_ingested_at"))
        changes.append_batch(b, table, "query", number)

    batch(e, 0, "Open", A.EARLIER_INGESTED_AT)
    batch(e.filter(r9 == 0), 1, "Moved", A.FIXED_INGESTED_AT, days=1)
    changes.compact(spark, table)
    batch(e.filter(r9.isin(3, 8)), 2, "Open", A.FIXED_INGESTED_AT)
    batch(e.filter(r9.isin(3, 8)), 2, "Open", A.FIXED_INGESTED_AT)               # replayed: nothing
    return changes.read_latest(spark, table).select("unique_key", "descriptor", "status", "_created_day", "_ingested_at")


def census_dimension_loads(spark, sf):
    """The demographic dimension from three loads in no order of years; equals the one built at once."""
    rows = catalog._region_year_demographics(spark, sf)
    year = F.pmod("survey_year", F.lit(3))
    path = shared_path(spark, "census_dimension")
    stored = T.StructType([rows.schema["borough"], *[rows.schema[m] for m in models.MEASURES],
                           T.StructField("valid_from", T.IntegerType()), T.StructField("valid_to", T.IntegerType()),
                           T.StructField("is_current", T.BooleanType()), T.StructField("observed", T.ArrayType(T.IntegerType()))])
    versions.create(spark, path, stored)
    for part in (1, 0, 2):
        merged = history.scd2_merge(versions.read(spark, path), rows.filter(year == part), ["borough"], "survey_year", models.MEASURES)
        versions.replace_keys(merged.select(*stored.names), path, ["borough"])
    return versions.read(spark, path).withColumnsRenamed({"valid_from": "valid_from_year", "valid_to": "valid_to_year"}).select(
        "borough", *models.MEASURES, "valid_from_year", "valid_to_year", "is_current")


def census_density(spark, sf):
    """Persons per housing unit over the merged survey table, read from its versions."""
    return models.census_density(census_merge_files(spark, sf))


def page_deep(spark, sf):
    """The last full page of the events in stored order, by number and by the key before it."""
    e = catalog._t(spark, sf, "events").select("event_id", "ts", "event_type")
    path, order = shared_path(spark, "event_pages"), ["ts", "event_id"]
    keyset.store(e, path, order, rows_per_file=A.ROWS_PER_PAGE)
    rows = keyset.directory(spark, path, e.schema, order).agg(F.sum("rows")).first()[0] or 0
    size = catalog.PAGE_ROWS // 4
    last = max(0, rows // size - 1)
    by_number = keyset.page(spark, path, e.schema, order, last, size).withColumn("found_by", F.lit("number"))
    before = keyset.page(spark, path, e.schema, order, max(0, last - 1), size).orderBy(F.desc("ts"), F.desc("event_id")).first()
    by_key = keyset.page_after(spark, path, e.schema, order, (before["ts"], before["event_id"]), size)
    return by_number.unionByName(by_key.withColumn("found_by", F.lit("key")))


QUERIES = {
    "incremental_landing": incremental_landing,
    "load_history": load_history,
    "load_chunks": load_chunks,
    "landing_outcomes": landing_outcomes,
    "requests_upsert": requests_upsert,
    "census_merge_files": census_merge_files,
    "requests_feed_order": requests_feed_order,
    "requests_changes": requests_changes,
    "census_dimension_loads": census_dimension_loads,
    "page_deep": page_deep,
    "census_density": census_density,
}

# --- the same rows in SQL -----------------------------------------------------------------

_CUT = f"SELECT max(ts) AS m, CAST(max(ts) AS DATE) - {LATE_DAYS} AS cut FROM events"
_WEATHER_REASON = """CASE WHEN event_id % 11 = 1 THEN 'empty' WHEN event_id % 11 = 2 THEN 'not an object'
  WHEN event_id % 10 = 1 THEN 'missing: coord.lat' WHEN event_id % 10 = 2 THEN 'missing: weather[0].main'
  WHEN event_id % 10 = 3 THEN 'missing: main.humidity' WHEN event_id % 10 = 4 THEN 'missing: sys.sunrise'
  WHEN event_id % 10 = 5 THEN 'missing: rain' WHEN event_id % 10 = 6 THEN 'missing: wind'
  WHEN event_id % 10 = 7 THEN 'missing: dt' WHEN event_id % 11 = 3 THEN 'not a number: main.temp'
  WHEN event_id % 11 = 4 THEN 'over length: city_name'
  ELSE 'loaded' END"""

SQL = {
    "incremental_landing": f"""
WITH b AS ({_CUT}), r AS ({oracle.REQUEST_ROWS})
SELECT r.*, 'historical' AS _ingestion_mode, 'nyc_open_data_311' AS _source,
  CASE WHEN CAST(e.ts AS DATE) < b.cut THEN {oracle.EARLIER} ELSE {oracle.FIXED} END AS _ingested_at,
  CAST(e.ts AS DATE) AS _created_day
FROM r JOIN events e ON r.unique_key = CAST(e.event_id AS VARCHAR), b WHERE e.ts >= {oracle._bound('b.m', 90)}""",
    "load_history": f"""
WITH b AS ({_CUT})
SELECT CAST(1 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS rejected
UNION ALL SELECT 2, 'append', count(*), 0 FROM events, b WHERE CAST(ts AS DATE) < cut AND ts >= {oracle._bound('m', 90)}
UNION ALL SELECT 3, 'append', count(*), 0 FROM events, b WHERE CAST(ts AS DATE) >= cut AND ts >= {oracle._bound('m', 90)}""",
    "load_chunks": f"""
WITH b AS ({_CUT}),
d AS (SELECT CASE WHEN CAST(ts AS DATE) < cut THEN 2 ELSE 3 END::BIGINT AS version,
             CAST(CAST(ts AS DATE) AS VARCHAR) AS created_day, count(*) AS rows,
             min(CAST(event_id AS VARCHAR)) AS first_key, max(CAST(event_id AS VARCHAR)) AS last_key
      FROM events, b WHERE ts >= {oracle._bound('m', 90)} GROUP BY 1, 2)
SELECT version, row_number() OVER w AS chunk_no, created_day, rows, first_key, last_key,
  CAST(sum(rows) OVER w AS BIGINT) AS total_rows,
  created_day = max(created_day) OVER (PARTITION BY version) AS is_last
FROM d WINDOW w AS (PARTITION BY version ORDER BY created_day)""",
    "landing_outcomes": f"""
WITH p AS (SELECT event_id // {A.ROWS_PER_PAGE} AS page, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT c_nationkey % 3 AS c, c_nationkey, c_custkey // {A.ROWS_PER_SURVEY_DOC} AS chunk, count(*) AS n
      FROM customer GROUP BY 1, 2, 3),
a AS (
  SELECT 'nyc_open_data_311' AS source, CASE page % 5 WHEN 1 THEN 'malformed' WHEN 2 THEN 'empty' ELSE 'loaded' END AS reason,
    CASE WHEN page % 5 IN (1, 2) THEN 1 ELSE n END AS n FROM p
  UNION ALL SELECT 'nyc_open_data_311', 'not an object', 2 FROM p WHERE page % 5 = 3
  UNION ALL SELECT 'openweather_api', {_WEATHER_REASON}, 1 FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'us_census_bureau_acs5', CASE c WHEN 1 THEN 'no header' WHEN 2 THEN 'malformed' ELSE 'loaded' END,
    CASE WHEN c = 0 THEN n ELSE 1 END FROM s)
SELECT source, reason, CAST(sum(n) AS BIGINT) AS n FROM a GROUP BY 1, 2""",
    "requests_upsert": f"""
SELECT CAST(event_id AS VARCHAR) AS unique_key, 'Open' AS status,
  CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS _created_day, {oracle.EARLIER} AS _ingested_at
FROM events WHERE event_id % 9 NOT IN (0, 3)
UNION ALL
SELECT CASE event_id % 9 WHEN 6 THEN 'N' || CAST(event_id AS VARCHAR) WHEN 8 THEN NULL ELSE CAST(event_id AS VARCHAR) END,
  event_type, CASE event_id % 9 WHEN 0 THEN CAST(ts AS DATE) + 1 WHEN 3 THEN NULL ELSE CAST(ts AS DATE) END, {oracle.FIXED}
FROM events WHERE event_id % 9 IN (0, 3, 6, 8)""",
    "census_merge_files": oracle.CENSUS_MERGE,
    "requests_feed_order": f"""
SELECT CAST(event_id AS VARCHAR) AS unique_key,
  CASE WHEN event_id % 3 = 0 THEN 'Reopened' WHEN event_id % 2 = 1 THEN 'Closed' ELSE 'Open' END AS status,
  CASE WHEN event_id % 3 <> 0 AND event_id % 2 = 1 THEN strftime(ts, {oracle.ISO}) ELSE '' END AS closed_date
FROM events, (SELECT max(ts) AS m FROM events) b WHERE ts >= {oracle._bound('b.m', 90)}""",
    "requests_changes": f"""
SELECT CASE WHEN event_id % 9 <> 8 THEN CAST(event_id AS VARCHAR) END AS unique_key, CAST(event_id AS VARCHAR) AS descriptor,
  CASE WHEN event_id % 9 = 0 THEN 'Moved' ELSE 'Open' END AS status,
  CASE WHEN event_id % 9 = 0 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS _created_day,
  CASE WHEN event_id % 9 IN (0, 3, 8) THEN {oracle.FIXED} ELSE {oracle.EARLIER} END AS _ingested_at
FROM events""",
    "census_dimension_loads": oracle.SQL["census_dimension"],
    "page_deep": f"""
WITH i AS ({oracle.ROW_IDX}), n AS (SELECT count(*) // 250 - 1 AS last FROM events)
SELECT e.event_id, e.ts, e.event_type, f.found_by
FROM events e JOIN i ON i.event_id = e.event_id, n, (VALUES ('number'), ('key')) f(found_by)
WHERE i.idx >= n.last * 250 AND i.idx < (n.last + 1) * 250""",
    "census_density": f"""
SELECT borough, survey_year, total_population, total_housing_units,
  round(total_population / nullif(total_housing_units, 0), 4) AS density
FROM ({oracle.CENSUS_MERGE})""",
}
