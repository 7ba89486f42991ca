"""Payloads to rows and rejects in one parse.

Every landed payload, and every record in it, has an outcome: a row, or a reject
with a reason.  ``*_outcomes`` give one frame with both: the feed's columns,
``path``, ``position`` (place in the payload, from 0), ``reason`` (null for a row)
and ``payload`` (text of what was rejected).  ``counted`` names what to observe
while that frame is written, so the counts cost no pass of their own.

Reasons: ``empty``, ``malformed`` (no such document), ``not an object``, ``no
header``, ``missing: <path>``, ``not a number: <path>``, ``over length: <column>``.
A payload of an empty list has no outcome: it is how a feed ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X
from civicspark.operators import census, requests, weather
from civicspark.schemas import Col
from civicspark.sources.landing import CENSUS_DOC_SCHEMA, REQUEST_PAGE_SCHEMA, WEATHER_NUMBERS

OUTCOME = ["path", "modified", "position", "reason", "payload"]
REJECT = "source string, path string, position int, reason string, payload string, _ingested_at timestamp_ntz"
KINDS = ["empty", "malformed", "not an object", "no header", "missing", "not a number", "over length"]


def over_length_reason(contract: list[Col]) -> Column:
    """Reason of the first column over its declared length; null if there is none."""
    return F.coalesce(*[F.when(X.over_length(c, n), F.lit(f"over length: {c}"))
                        for c, n in schemas.max_lengths(contract).items()], F.lit(None).cast("string"))


def _whole(value: Column) -> Column:
    """Why a payload that does not parse was rejected."""
    return F.when(F.trim(F.regexp_replace(value, r"[\t\r\n]", " ")) == "", "empty").otherwise("malformed")


def request_outcomes(payloads: DataFrame, ingested_at, mode: str) -> DataFrame:
    """``requests_raw`` columns of every record.  A page that is no list of objects is parsed once
    more, record by record, so that its good records are kept."""
    value = F.col("value")
    none, text = F.lit(None).cast("map<string,string>"), F.lit(None).cast("string")
    good = F.transform(F.from_json(value, REQUEST_PAGE_SCHEMA),
                       lambda r: F.struct(r.alias("record"), text.alias("payload"), text.alias("reason")))
    mixed = F.transform(F.from_json(value, "array<string>"),
                        lambda t: F.struct(F.from_json(t, "map<string,string>").alias("record"),
                                           F.coalesce(t, F.lit("null")).alias("payload"),
                                           F.lit("not an object").alias("reason")))
    broken = F.array(F.struct(none.alias("record"), value.alias("payload"), _whole(value).alias("reason")))
    records = payloads.select("path", "modified", F.posexplode(F.coalesce(good, mixed, broken)).alias("position", "r"))
    rows = requests.project_records(records.select(
        "path", "modified", "position", "r.record", F.when(F.col("r.record").isNull(), F.col("r.reason")).alias("reason"),
        F.when(F.col("r.record").isNull(), F.col("r.payload")).alias("payload")))
    rows = requests.add_lineage(rows, ingested_at, C.SOURCE_REQUESTS, mode)
    reason = F.coalesce("reason", over_length_reason(schemas.REQUESTS_RAW))
    return _tagged(rows, reason, schemas.REQUESTS_RAW, F.coalesce("payload", F.to_json(F.struct(*C.REQUEST_COLUMNS))))


WEATHER_PATHS = {"coord": ["lat", "lon"], "main": ["temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity"],
                 "wind": ["speed", "deg"], "clouds": ["all"], "rain": ["1h"], "snow": ["1h"], "sys": ["sunrise", "sunset"]}


def _not_a_number(doc: Column) -> Column:
    """Reason of the first numeric path that holds something else; null if there is none."""
    paths = [(f"{a}.{b}", f"$.{a}['{b}']") for a, bs in WEATHER_PATHS.items() for b in bs]
    paths += [("visibility", "$.visibility"), ("dt", "$.dt")]
    bad = []
    for name, path in paths:
        v = F.try_variant_get(doc, path, "variant")
        bad.append(F.when(v.isNotNull() & ~F.is_variant_null(v) & F.try_variant_get(doc, path, "double").isNull(),
                          F.lit(f"not a number: {name}")))
    return F.coalesce(*bad)


def weather_outcomes(payloads: DataFrame, ingested_at) -> DataFrame:
    """``weather_raw`` columns of every document (``borough`` from the landing folder)."""
    value = F.col("value")
    # parsed in a one-element explode, so that all look-ups read one parse
    docs = payloads.select("path", "modified", "borough", "value", F.explode(F.array(F.try_parse_json(value))).alias("doc"))
    issue = F.try_element_at(weather.issues("doc"), F.lit(1))
    reason = (F.when(F.col("doc").isNull(), _whole(value))
              .when(F.try_variant_get("doc", "$", "map<string,variant>").isNull(), "not an object")
              .when(issue.isNotNull(), F.concat(F.lit("missing: "), issue))
              .otherwise(_not_a_number(F.col("doc"))))
    checked = docs.select("*", F.explode(F.array(reason)).alias("reason"), F.from_json(value, WEATHER_NUMBERS).alias("num"))
    rows = checked.select("path", "modified", F.lit(0).alias("position"), "reason", F.col("value").alias("payload"),
                          *weather.flat_columns(), X.as_of_literal(ingested_at).alias("_ingested_at"),
                          F.lit(C.SOURCE_WEATHER).alias("_source"))
    return _tagged(rows, F.coalesce("reason", over_length_reason(schemas.WEATHER_RAW)), schemas.WEATHER_RAW, F.col("payload"))


def survey_outcomes(payloads: DataFrame, ingested_at, survey_year: int = C.SURVEY_YEAR) -> DataFrame:
    """``census_raw`` columns of every data row."""
    value = F.col("value")
    docs = payloads.select("path", "modified", "value", F.explode(F.array(F.from_json(value, CENSUS_DOC_SCHEMA))).alias("doc"))
    header = F.get("doc", F.lit(0))
    why = (F.when(F.col("doc").isNull(), _whole(value)).when(F.size("doc") == 0, "no header")
           .when(header.isNull(), "no header"))
    rows = F.slice("doc", 2, F.greatest(F.size("doc") - 1, F.lit(0)))
    none = F.lit(None).cast("array<string>")
    items = F.when(why.isNotNull(), F.array(F.struct(none.alias("row"), value.alias("payload"), why.alias("reason"))))\
        .otherwise(F.transform(rows, lambda r: F.struct(r.alias("row"), F.to_json(r).alias("payload"),
                                                        F.when(r.isNull(), "not an object").alias("reason"))))
    each = docs.select("path", "modified", header.alias("header"), F.posexplode(items).alias("position", "r"))
    keyed = each.select("path", "modified", "position", "r.payload", F.col("r.reason").alias("why"), F.explode(F.array(
        F.when(F.col("r.reason").isNull(), X.zip_header(F.col("header"), F.col("r.row"))))).alias("data"))
    clean = census.clean(keyed, ingested_at, survey_year, keep=["path", "modified", "position", "payload", "why"])
    return _tagged(clean, F.coalesce("why", over_length_reason(schemas.CENSUS_RAW)), schemas.CENSUS_RAW, F.col("payload"))


def _tagged(rows: DataFrame, reason: Column, contract: list[Col], payload: Column) -> DataFrame:
    return rows.select("path", "modified", "position", reason.alias("reason"),
                       F.when(reason.isNotNull(), payload).alias("payload"), *[c.name for c in contract])


def counted() -> list[Column]:
    """Aggregates to ``observe``: rows, and rejects by kind of reason."""
    kind = F.split("reason", ":").getItem(0)
    return [F.count_if(F.col("reason").isNull()).alias("rows"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
            *[F.count_if(kind == k).alias(k) for k in KINDS]]


def rejects(outcomes: DataFrame, source: str, ingested_at) -> DataFrame:
    """The dead-letter rows of an outcome frame."""
    return outcomes.filter(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), "path", "position", "reason", "payload",
        X.as_of_literal(ingested_at).alias("_ingested_at"))
