"""Registered queries: one per operator group of the survey inventory.

Each takes ``(spark, sf_dir)``, reads the shared test tables (or data Spark
derives from them) in full and returns a DataFrame.  Column names match the
oracle SQL in :mod:`civicspark.plans.oracle`.
"""

from __future__ import annotations

import weakref
import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import analytics, census, history, paging, quality, requests, weather
from civicspark.plans import adapters as A
from civicspark.plans import models
from civicspark.session import shared_path
from civicspark.sinks import tables as sinks
from civicspark.sources.landing import explode_census_docs, explode_request_pages, parse_weather_docs
from civicspark.sources.tables import read_table

PAGE_ROWS = 1_000          # page size of the paging queries (multi-page at test scale)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


_VIEWS: "weakref.WeakKeyDictionary[SparkSession, set[str]]" = weakref.WeakKeyDictionary()


def landing_view(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The landed payloads of a feed as a session temporary view (a stored
    logical plan, no cached data): registered on first use, then referenced
    by name.  Every execution still reads the tables and parses everything."""
    name = f"landing_{kind}_{zlib.crc32(sf.encode()):08x}"
    known = _VIEWS.setdefault(spark, set())
    if name not in known:
        events, region = _t(spark, sf, "events"), _t(spark, sf, "region")
        build = {
            "request_records": lambda: A.request_records(events, region),
            "request_pages": lambda: A.request_pages(landing_view(spark, sf, "request_records"))
            .select("value"),
            "weather_docs": lambda: A.weather_docs(events, region),
            "weather_docs_broken": lambda: A.weather_docs(events, region, broken=True),
            "survey_docs": lambda: A.survey_docs(_t(spark, sf, "customer")).select("value"),
        }[kind]
        build().createOrReplaceTempView(name)
        known.add(name)
    try:
        return spark.table(name)
    except AnalysisException:          # the view was dropped: register it again
        known.discard(name)
        return landing_view(spark, sf, kind)


def _as_of(spark, sf) -> "F.Column":
    """Load time of the registered queries: the newest event (a scalar subquery)."""
    return _t(spark, sf, "events").select(F.max("ts")).scalar()


def _records(spark, sf) -> DataFrame:
    return landing_view(spark, sf, "request_records")


def _landed_records(spark, sf) -> DataFrame:
    return explode_request_pages(landing_view(spark, sf, "request_pages"))


def _request_rows(spark, sf) -> DataFrame:
    return requests.project_records(_landed_records(spark, sf))


def _weather_rows(spark, sf, ingested_at=A.FIXED_INGESTED_AT) -> DataFrame:
    docs = landing_view(spark, sf, "weather_docs")
    return weather.flatten(parse_weather_docs(docs.select("borough", "value")), ingested_at)


def _survey_rows(spark, sf) -> DataFrame:
    docs = landing_view(spark, sf, "survey_docs")
    return explode_census_docs(docs).withColumn("name", F.col("data")["NAME"])


# --- scans, projections, defaults ------------------------------------------------

def requests_project(spark, sf):
    return requests.project_records(_records(spark, sf).select("record"))


def requests_default_missing(spark, sf):
    return _request_rows(spark, sf)


def requests_union_pages(spark, sf):
    rows, as_of = _request_rows(spark, sf), _as_of(spark, sf)
    runs = [requests.window_for_mode(rows, m, as_of)
            .select("unique_key", "created_date", F.lit(m).alias("_ingestion_mode"))
            for m in ("historical", "incremental")]
    return runs[0].unionByName(runs[1])


# --- windows by mode -------------------------------------------------------------

def lookback_incremental(spark, sf):
    e = _t(spark, sf, "events")
    since = X.lookback_bound("incremental", _as_of(spark, sf))
    return e.filter(F.col("ts") >= since).select("event_id", "ts", since.alias("since"))


def lookback_historical(spark, sf):
    o = _t(spark, sf, "orders")
    since = X.lookback_bound("historical", o.select(F.max("o_orderdate")).scalar())
    return (o.filter(F.col("o_orderdate") >= since)
            .select("o_orderkey", "o_orderdate", since.alias("since")))


# --- paging and load accounting --------------------------------------------------

def page_slice(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return paging.page_slice(e, ["ts", "event_id"], page_no=1, page_size=PAGE_ROWS)


def page_index(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts")
    return paging.page_report(e, ["ts", "event_id"], "event_id", PAGE_ROWS)


def load_batches(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "ts")
    return paging.batch_report(e, ["ts", "event_id"], "event_id", C.INSERT_BATCH_SIZE)


def load_counts(spark, sf):
    """Rows each load would append, per source and mode.  Both request windows
    are counted in one pass over the landed rows (conditional counts), not by
    running the two loads."""
    rows, as_of = _request_rows(spark, sf), _as_of(spark, sf)
    t = X.iso_to_ntz("created_date")
    modes = ["historical", "incremental"]
    req = rows.agg(*[F.count_if(t >= X.lookback_bound(m, as_of)).alias(m) for m in modes])
    req = req.select(F.inline(F.array(*[
        F.struct(F.lit(C.SOURCE_REQUESTS).alias("_source"), F.lit(m).alias("_ingestion_mode"),
                 F.col(m).alias("loaded_rows")) for m in modes])))
    wx = _weather_rows(spark, sf).agg(F.count(F.lit(1)).alias("loaded_rows")).select(
        F.lit(C.SOURCE_WEATHER).alias("_source"), F.lit(None).cast("string").alias("_ingestion_mode"),
        "loaded_rows")
    return req.unionByName(wx)


# --- survey feed -----------------------------------------------------------------

def census_header_rows(spark, sf):
    d = F.col("data")
    return _survey_rows(spark, sf).select(
        "name",
        d["B01003_001E"].alias("pop_text"), d["B19013_001E"].alias("income_text"),
        d["B17001_002E"].alias("below_text"), d["B25001_001E"].alias("housing_text"),
        d["B08006_001E"].alias("workers_text"),
        X.get_or_default(d, "state", C.DEFAULT_STATE_FIPS).alias("state_text"),
        X.get_or_default(d, "county", "").alias("county_text"))


def census_clean(spark, sf):
    return census.clean(_survey_rows(spark, sf), A.FIXED_INGESTED_AT, keep=["name"])


def county_filter(spark, sf):
    c = census.clean(_survey_rows(spark, sf), A.FIXED_INGESTED_AT, keep=["name"])
    return census.filter_counties(c).select("name", "county_fips", "state_fips")


def fips_lookup(spark, sf):
    rows = _survey_rows(spark, sf).select(
        "name", X.get_or_default(F.col("data"), "county", "").alias("county_fips"))
    return census.borough_of_county(rows)


def poverty_rate(spark, sf):
    o = (_t(spark, sf, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f")))
    c = _t(spark, sf, "customer").select("c_custkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.select(
        "c_custkey",
        F.coalesce("n", F.lit(0)).alias("total_orders"),
        F.coalesce("f", F.lit(0)).alias("f_orders"),
        X.guarded_rate(F.col("f").cast("double"), F.col("n").cast("double")).alias("poverty_rate_pct"))


def _order_demographics(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    st = F.col("o_orderstatus")
    a = (o.groupBy("o_custkey", F.year("o_orderdate").cast("int").alias("survey_year"),
                   F.pmod("o_orderkey", F.lit(2)).alias("side"))
         .agg(F.count(F.lit(1)).cast("double").alias("total_population"),
              F.max("o_totalprice").alias("median_household_income"),
              F.count_if(st == "F").cast("double").alias("population_below_poverty"),
              F.count_if(st == "O").cast("double").alias("total_housing_units"),
              F.nullif(F.count_if(st == "P"), F.lit(0)).cast("double").alias("total_workers_commuting")))
    target = F.col("side") == 0
    a = a.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("borough"),
        F.when(target, "T").otherwise("S").alias("county_fips"),
        F.lit(C.DEFAULT_STATE_FIPS).alias("state_fips"),
        "survey_year", "total_population", "median_household_income", "population_below_poverty",
        "total_housing_units", "total_workers_commuting",
        X.guarded_rate("population_below_poverty", "total_population").alias("poverty_rate_pct"),
        F.when(target, X.as_of_literal(A.EARLIER_INGESTED_AT))
        .otherwise(X.as_of_literal(A.FIXED_INGESTED_AT)).alias("_ingested_at"),
        F.when(target, "target_load").otherwise("source_load").alias("_source"),
        "side")
    return a


def census_merge(spark, sf):
    """Keyed upsert through the table sink: the even-order half is the stored
    table (partitioned by year), the odd half is merged into it."""
    a = _order_demographics(spark, sf)
    names = [c.name for c in schemas.CENSUS_RAW]
    path = shared_path(spark, "census_merge")
    sinks.append(a.filter("side = 0").select(*names), path, partition_by=["survey_year"])
    sinks.upsert(a.filter("side = 1").select(*names), path, schemas.CENSUS_KEY,
                 schemas.CENSUS_UPDATE, partition_col="survey_year")
    return spark.read.parquet(path).select(*names)


# --- sinks and lineage -------------------------------------------------------------

def requests_append(spark, sf):
    rows, as_of = _request_rows(spark, sf), _as_of(spark, sf)
    path = shared_path(spark, "requests_raw")
    for mode, at in (("historical", A.EARLIER_INGESTED_AT), ("incremental", A.FIXED_INGESTED_AT)):
        load = requests.add_lineage(requests.window_for_mode(rows, mode, as_of), at,
                                    C.SOURCE_REQUESTS, mode)
        sinks.load_feed(load, path, "requests_raw")
    return spark.read.parquet(path).select(
        "unique_key", "created_date", "_ingestion_mode", "_ingested_at", "_source")


def weather_append(spark, sf):
    as_of = _as_of(spark, sf)
    path = shared_path(spark, "weather_raw")
    sinks.load_feed(_weather_rows(spark, sf, A.EARLIER_INGESTED_AT), path, "weather_raw")
    reread = requests.window_for_mode(_weather_rows(spark, sf, A.FIXED_INGESTED_AT), "incremental",
                                      as_of, col="observation_timestamp")
    sinks.load_feed(reread, path, "weather_raw")
    return spark.read.parquet(path).select(
        "borough", "observation_timestamp", "temp_celsius", "rain_1h_mm", "_ingested_at", "_source")


def lineage_columns(spark, sf):
    rows = requests.window_for_mode(_request_rows(spark, sf), "incremental", _as_of(spark, sf))
    return requests.add_lineage(rows, A.FIXED_INGESTED_AT, C.SOURCE_REQUESTS, "incremental").select(
        "unique_key", "_ingested_at", "_ingestion_mode", "_source")


def table_contract(spark, sf):
    part = requests_project(spark, sf).select("unique_key", "created_date", "complaint_type")
    part = part.withColumns({"_ingested_at": X.as_of_literal(A.FIXED_INGESTED_AT),
                             "_ingestion_mode": F.lit("incremental")})
    return quality.conform(part, schemas.REQUESTS_RAW)


def length_violations(spark, sf):
    return quality.length_violations(_t(spark, sf, "events"), {"event_type": 5, "props": 9})


# --- weather feed ------------------------------------------------------------------

def weather_flatten(spark, sf):
    return _weather_rows(spark, sf)


def weather_required_fields(spark, sf):
    docs = landing_view(spark, sf, "weather_docs_broken")
    checked = parse_weather_docs(docs.select("value")).select(weather.issues("doc").alias("i"))
    reason = F.coalesce(F.try_element_at("i", F.lit(1)), F.lit("ok"))
    return checked.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def weather_epoch(spark, sf):
    e = _t(spark, sf, "events")
    ep = X.ntz_to_epoch("ts")
    return e.select("event_id", ep.alias("epoch_s"), X.epoch_to_ntz(ep).alias("observation_timestamp"))


def iso_to_timestamp(spark, sf):
    e = _t(spark, sf, "events")
    text = F.concat(X.ntz_to_iso_ms("ts"),
                    F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit("+00:00")).otherwise(F.lit("")))
    return e.select("event_id", text.alias("iso_text"), X.iso_to_ntz(text).alias("parsed"))


# --- staging and history models ----------------------------------------------------

def requests_latest(spark, sf):
    """Latest row per request over two loads: a historical back-fill, then an
    incremental load whose 3-day look-back re-reads the newest rows."""
    rows, as_of = _request_rows(spark, sf), _as_of(spark, sf)
    loads = [requests.add_lineage(requests.window_for_mode(rows, m, as_of), at, C.SOURCE_REQUESTS, m)
             for m, at in (("historical", A.EARLIER_INGESTED_AT), ("incremental", A.FIXED_INGESTED_AT))]
    raw = loads[0].unionByName(loads[1])
    return models.requests_latest(raw).select("unique_key", "status", "_ingested_at", "_ingestion_mode")


def requests_daily(spark, sf):
    """Request volume per borough and local day (the request feed's times are
    local wall clock), on the latest row of each request."""
    rows = requests.add_lineage(_request_rows(spark, sf), A.FIXED_INGESTED_AT, C.SOURCE_REQUESTS,
                                "historical")
    return models.requests_daily(rows)


def weather_request_correlation(spark, sf):
    """The correlation model: non-view events as requests (local times), view
    events as UTC observations aligned to the local day, demographics from the
    current version of the census dimension."""
    recs = _records(spark, sf).filter(F.col("event_type") != "view").select("record")
    raw = requests.add_lineage(requests.project_records(recs), A.FIXED_INGESTED_AT,
                               C.SOURCE_REQUESTS, "historical")
    out = models.weather_request_correlation(raw, _weather_rows(spark, sf),
                                             _region_year_demographics(spark, sf))
    return out.select("borough", "n_days", "requests", "corr_temp", "total_population",
                      "poverty_rate_pct")


def requests_typed(spark, sf):
    return requests.typed_requests(_request_rows(spark, sf)).select(
        "unique_key", "created_at", "closed_at", "latitude_d", "longitude_d")


def latest_request(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return history.latest_by_key(e, ["user_id"], ["ts", "event_id"])


def borough_normalise(spark, sf):
    e = A.with_region(_t(spark, sf, "events").select("event_id", "user_id"), _t(spark, sf, "region"))
    r3 = F.pmod("event_id", F.lit(3))
    raw = (F.when(r3 == 0, F.col("r_name"))
           .when(r3 == 1, F.lower("r_name"))
           .otherwise(F.concat(F.lit("  "), F.regexp_replace(F.initcap("r_name"), " ", "  "), F.lit(" "))))
    return (e.select(X.normalise_borough(raw).alias("borough"))
            .groupBy("borough").agg(F.count(F.lit(1)).alias("n_requests")))


def local_day(spark, sf):
    return _t(spark, sf, "events").select("event_id", X.local_day("ts").alias("local_day"))


def scd2_dimension(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return history.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"], "ts")


def _region_year_demographics(spark, sf) -> DataFrame:
    """``census_raw``-shaped rows per (region as borough, order year): customers
    who ordered, their largest order, status counts; the rate is guarded."""
    o = _t(spark, sf, "orders")
    st = F.col("o_orderstatus")
    per_cust = (o.groupBy("o_custkey", F.year("o_orderdate").cast("int").alias("survey_year"))
                .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"),
                     F.count_if(st == "F").alias("f"), F.count_if(st == "P").alias("p")))
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = _t(spark, sf, "region").select("r_regionkey", "r_name")
    j = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    agg = j.groupBy(F.col("r_name").alias("borough"), "survey_year").agg(
        F.count(F.lit(1)).cast("double").alias("total_population"),
        F.max("top").alias("median_household_income"),
        F.sum("f").cast("double").alias("population_below_poverty"),
        F.sum("n").cast("double").alias("total_housing_units"),
        F.nullif(F.sum("p"), F.lit(0)).cast("double").alias("total_workers_commuting"))
    return agg.withColumn("poverty_rate_pct",
                          X.guarded_rate("population_below_poverty", "total_population"))


def census_dimension(spark, sf):
    """The SCD2 demographic model over census-shaped rows: borough key,
    versions by survey year."""
    return models.census_dimension(_region_year_demographics(spark, sf)).select(
        "borough", *models.MEASURES, "valid_from_year", "valid_to_year", "is_current")


def yoy_change(spark, sf):
    per_cust = (_t(spark, sf, "orders")
                .groupBy("o_custkey", F.year("o_orderdate").cast("int").alias("year"))
                .agg(F.count(F.lit(1)).alias("n")))
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = _t(spark, sf, "region").select("r_regionkey", "r_name")
    j = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    agg = j.groupBy(F.col("r_name").alias("region"), "year").agg(F.sum("n").alias("n_orders"))
    return analytics.change_vs_previous(agg, ["region"], "year", "n_orders", "prev_orders", "change")


def density_proxy(spark, sf):
    c = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("cn"))
    s = _t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("sn"))
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = (n.join(c, n.n_nationkey == c.k, "left").drop("k")
         .join(s, n.n_nationkey == s.k, "left").drop("k"))
    return j.select("n_nationkey", "n_name",
                    F.coalesce("cn", F.lit(0)).alias("n_customers"),
                    F.coalesce("sn", F.lit(0)).alias("n_suppliers"),
                    analytics.ratio("cn", "sn", 4).alias("density"))


def daily_volume(spark, sf):
    return analytics.daily_volume(_t(spark, sf, "events"), "ts", ["event_type"])


def _region_demographics(spark, sf) -> DataFrame:
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = _t(spark, sf, "region").select("r_regionkey", "r_name")
    c = (_t(spark, sf, "customer").select("c_nationkey", "c_acctbal")
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return c.groupBy(F.col("r_name").alias("borough")).agg(
        F.count(F.lit(1)).alias("population"),
        X.guarded_rate(F.count_if(F.col("c_acctbal") < 0).cast("double"),
                       F.count(F.lit(1)).cast("double")).alias("low_rate"))


def weather_correlation(spark, sf):
    """Flagship: request volume vs. mean temperature per borough and day,
    correlated per borough, with the borough's demographics."""
    recs = _records(spark, sf).filter(F.col("event_type") != "view").select("record")
    reqs = requests.typed_requests(requests.project_records(recs))
    obs = _weather_rows(spark, sf)
    return analytics.weather_vs_requests(reqs, obs, _region_demographics(spark, sf)).select(
        "borough", "n_days", "requests", "corr_temp", "population", "low_rate")


QUERIES = {
    "requests_project": requests_project,
    "requests_default_missing": requests_default_missing,
    "requests_union_pages": requests_union_pages,
    "lookback_incremental": lookback_incremental,
    "lookback_historical": lookback_historical,
    "page_slice": page_slice,
    "page_index": page_index,
    "load_batches": load_batches,
    "load_counts": load_counts,
    "county_filter": county_filter,
    "fips_lookup": fips_lookup,
    "weather_flatten": weather_flatten,
    "weather_required_fields": weather_required_fields,
    "weather_epoch": weather_epoch,
    "iso_to_timestamp": iso_to_timestamp,
    "census_header_rows": census_header_rows,
    "census_clean": census_clean,
    "poverty_rate": poverty_rate,
    "census_merge": census_merge,
    "requests_append": requests_append,
    "weather_append": weather_append,
    "lineage_columns": lineage_columns,
    "length_violations": length_violations,
    "table_contract": table_contract,
    "latest_request": latest_request,
    "requests_latest": requests_latest,
    "requests_daily": requests_daily,
    "weather_request_correlation": weather_request_correlation,
    "requests_typed": requests_typed,
    "borough_normalise": borough_normalise,
    "local_day": local_day,
    "scd2_dimension": scd2_dimension,
    "census_dimension": census_dimension,
    "yoy_change": yoy_change,
    "density_proxy": density_proxy,
    "daily_volume": daily_volume,
    "weather_correlation": weather_correlation,
}
