"""Adapters: the shared test tables -> feed-shaped records and landing payloads.

The feeds themselves are not in the test data, so each feed is derived from
a driver table with Spark (its volume grows with the table):

* requests     <- ``events`` (borough = region of ``user_id``), with keys
                  present / JSON null / absent depending on the row
* observations <- ``view`` events as nested weather documents
* survey rows  <- ``customer`` as header-plus-rows documents

Payload documents are grouped into bounded pages/documents (a fixed number
of rows each), never one document per table, so no task or group holds an
unbounded share of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark.functions import scalars as X
from civicspark.operators.util import spread

ROWS_PER_PAGE = 1_000        # records per landed request page
ROWS_PER_SURVEY_DOC = 100    # data rows per landed survey document
FIXED_INGESTED_AT = "2024-02-01 06:00:00"   # load time used by the registered queries
EARLIER_INGESTED_AT = "2024-01-15 00:00:00"

COUNTY_ROTATION = ["061", "005", "047", "081", "085", "999"]


def with_region(events: DataFrame, region: DataFrame) -> DataFrame:
    """events + ``r_name`` of region ``user_id mod 5``.  The join strategy is
    left to the planner: the dimension is broadcast only while its size
    estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (re-checked by
    AQE with runtime sizes), otherwise it is a shuffle join."""
    dim = region.select("r_regionkey", "r_name")
    return events.join(dim, F.pmod("user_id", F.lit(5)) == F.col("r_regionkey"), "left")


def request_records(events: DataFrame, region: DataFrame) -> DataFrame:
    """One ``record`` map per event with the feed's 15 text keys (plus an extra
    key the projection must drop).  Per row some keys are absent and some
    hold a JSON null."""
    e = with_region(spread(events, ["event_id"]), region)
    eid = F.col("event_id")
    r3, r5 = F.pmod(eid, F.lit(3)), F.pmod(eid, F.lit(5))
    entries: list[tuple[str, Column, Column | None]] = [
        ("unique_key", eid.cast("string"), None),
        ("created_date", X.ntz_to_iso_ms("ts"), None),
        ("closed_date", F.when(r3 == 0, X.ntz_to_iso_ms(F.timestamp_add("HOUR", F.lit(1), "ts"))),
         r3 == 2),
        ("complaint_type", F.col("event_type"), None),
        ("descriptor", F.col("props"), None),
        ("incident_zip", (F.col("user_id") + 10000).cast("string"), None),
        ("incident_address", F.when(r3 == 0, F.concat(F.lit("user "), F.col("user_id").cast("string"))),
         r3 == 1),
        ("city", F.lit("NEW YORK"), None),
        ("borough", F.col("r_name"), None),
        ("latitude", F.format_string("%.2f", "value"), None),
        ("longitude", F.format_string("-%.2f", "value"), None),
        ("status", F.when(F.col("event_type") == "error", "Open").otherwise("Closed"), None),
        ("resolution_description", F.concat(F.lit("resolved "), F.col("event_type")), r5 != 0),
        ("agency", F.concat(F.lit("AG"), F.pmod("user_id", F.lit(7)).cast("string")), None),
        ("agency_name", F.lit(None).cast("string"), F.lit(True)),
        ("user_id", F.col("user_id").cast("string"), None),
    ]
    # always-present keys in one map, conditional keys as one-entry maps
    # (empty when absent); all codegen'd, no per-row lambdas
    fixed = F.create_map(*[x for k, v, absent in entries if absent is None
                           for x in (F.lit(k), v.cast("string"))])
    empty = F.create_map().cast("map<string,string>")
    optional = [F.when(~absent, F.create_map(F.lit(k), v.cast("string"))).otherwise(empty)
                for k, v, absent in entries if absent is not None]
    record = F.map_concat(fixed, *optional)
    return e.select("event_id", "ts", "user_id", "event_type", record.alias("record"))


def request_pages(records: DataFrame, rows_per_page: int = ROWS_PER_PAGE) -> DataFrame:
    """Landed pages: JSON arrays of at most ``rows_per_page`` records."""
    page = (F.col("event_id") / F.lit(rows_per_page)).cast("long")
    return (records.groupBy(page.alias("page_no"))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json("record")), ","),
                          F.lit("]")).alias("value")))


def weather_docs(events: DataFrame, region: DataFrame, broken: bool = False) -> DataFrame:
    """``view`` events as nested observation documents, one per event, with the
    entity (``borough``) beside the document as a landing partition would give
    it.  Optional keys are absent on some rows (``to_json`` drops NULL fields).
    With ``broken=True`` some documents lose a required path."""
    v = with_region(spread(events.filter(F.col("event_type") == "view"), ["event_id"]), region)
    eid, val = F.col("event_id"), F.col("value")
    r10 = F.pmod(eid, F.lit(10))
    epoch = X.ntz_to_epoch("ts")
    cut = (lambda code: r10 == code) if broken else (lambda code: F.lit(False))

    def unless(cond, col):
        return F.when(~cond, col)

    coord = F.struct(unless(cut(1), val).alias("lat"), (-val).alias("lon"))
    sys_ = F.struct(F.when(F.pmod(eid, F.lit(5)) != 0, F.lit("US")).alias("country"),
                    unless(cut(4), epoch - 21600).alias("sunrise"),
                    (epoch + 21600).alias("sunset"))
    rainy = val > 25
    wx = F.when(cut(2), F.array().cast("array<struct<main:string,description:string,icon:string>>")) \
        .otherwise(F.array(F.struct(
            F.when(rainy, "Rain").otherwise("Clear").alias("main"),
            F.when(rainy, "light rain").otherwise("clear sky").alias("description"),
            F.when(rainy, "10d").otherwise("01d").alias("icon"))))
    main = F.struct(val.alias("temp"), (val - 1.5).alias("feels_like"),
                    (val - 2).alias("temp_min"), (val + 2).alias("temp_max"),
                    (F.pmod("user_id", F.lit(30)) + 1000).alias("pressure"),
                    unless(cut(3), F.pmod(eid, F.lit(100))).alias("humidity"))
    doc = F.struct(
        F.when(F.pmod(eid, F.lit(7)) != 0, F.concat(F.lit("Station "), F.col("user_id").cast("string")))
        .alias("name"),
        coord.alias("coord"), sys_.alias("sys"), wx.alias("weather"), main.alias("main"),
        F.when(F.pmod(eid, F.lit(4)) != 0, F.lit(10000)).alias("visibility"),
        unless(cut(6), F.struct((val / 10).alias("speed"), F.pmod(eid, F.lit(360)).alias("deg")))
        .alias("wind"),
        F.struct(F.pmod("user_id", F.lit(100)).alias("all")).alias("clouds"),
        F.when((F.pmod(eid, F.lit(3)) == 0) & ~cut(5), F.struct((val / 10).alias("1h"))).alias("rain"),
        F.when(F.pmod(eid, F.lit(10)) == 0, F.struct(F.lit(0.5).alias("1h"))).alias("snow"),
        unless(cut(7), epoch).alias("dt"),
    )
    text = F.to_json(doc)
    if broken:   # an explicit JSON null container (not expressible by to_json)
        text = F.when(cut(5), F.regexp_replace(text, r"^\{", '{"rain":null,')).otherwise(text)
    borough = F.initcap(F.col("r_name"))
    return v.select("event_id", "ts", borough.alias("borough"), text.alias("value"))


def survey_docs(customer: DataFrame, rows_per_doc: int = ROWS_PER_SURVEY_DOC) -> DataFrame:
    """``customer`` as header-plus-rows documents of at most ``rows_per_doc``
    rows.  Header order differs between documents (odd nations reversed) and
    nations ``n mod 5 = 4`` omit the ``state`` column, so the zip by name and
    the missing-key default are exercised."""
    k = F.col("c_custkey")
    county = F.element_at(F.array(*[F.lit(x) for x in COUNTY_ROTATION]),
                          (F.pmod(k, F.lit(6)) + 1).cast("int"))
    header = ["NAME", *C.SURVEY_VARIABLES, "state", "county"]
    cells = F.array(
        F.col("c_name"),
        (F.pmod(k, F.lit(50)) * 20).cast("string"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.lit("N/A"))
        .when(F.pmod(k, F.lit(10)) == 1, F.lit("-666666666"))
        .otherwise(F.col("c_acctbal").cast("string")),
        F.when(F.pmod(k, F.lit(13)) != 0, F.pmod(k, F.lit(7)).cast("string")),
        (F.col("c_nationkey") * 100 + 1).cast("string"),
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit("x")).otherwise(F.pmod(k, F.lit(31)).cast("string")),
        F.when(F.pmod(k, F.lit(19)) != 0, F.lit(C.DEFAULT_STATE_FIPS)),
        county,
    )
    nation = F.col("c_nationkey")
    no_state = F.pmod(nation, F.lit(5)) == 4
    state_pos = header.index("state")
    h = F.array(*[F.lit(x) for x in header])
    h = F.when(no_state, F.filter(h, lambda x, i: i != state_pos)).otherwise(h)
    c = F.when(no_state, F.filter(cells, lambda x, i: i != state_pos)).otherwise(cells)
    odd = F.pmod(nation, F.lit(2)) == 1
    h = F.when(odd, F.reverse(h)).otherwise(h)
    c = F.when(odd, F.reverse(c)).otherwise(c)
    rows = customer.select(nation.alias("nation"), (k / F.lit(rows_per_doc)).cast("long").alias("chunk"),
                           h.alias("h"), c.alias("c"))
    docs = rows.groupBy("nation", "chunk").agg(F.first("h").alias("h"), F.collect_list("c").alias("rows"))
    return docs.select("nation", "chunk",
                       F.to_json(F.concat(F.array(F.col("h")), F.col("rows"))).alias("value"))
