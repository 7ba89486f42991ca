"""Request feed: record projection, look-back window, lineage, typed staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X


def project_records(recs: DataFrame, record_col: str = "record",
                    columns: list[str] = C.REQUEST_COLUMNS) -> DataFrame:
    """Named keys of each flat record in target order.  An absent key becomes
    '' and a JSON null stays NULL; keys not in ``columns`` are dropped."""
    m = F.col(record_col)
    keep = [c for c in recs.columns if c != record_col]
    return recs.select(*[X.get_or_default(m, k, "").alias(k) for k in columns], *keep)


def filter_since(df: DataFrame, since: Column, col: str = "created_date") -> DataFrame:
    """Inclusive lower time bound, pushed to a Parquet scan when ``since`` is constant.

    Typed columns compare as timestamps.  Text is compared as a timestamp too; what
    reaches the scan is a bound on the text itself, by the day, which lets through
    every text that may be late enough: those that begin with a blank or a sign
    (all below '0') are left to the exact comparison."""
    c = F.col(col)
    if dict(df.dtypes).get(col) == "string":
        day = F.substring(since.cast("string"), 1, 10)
        return df.filter((c >= day) | (c < "0")).filter(X.iso_to_ntz(c) >= since)
    return df.filter(c >= since)


def window_for_mode(df: DataFrame, mode: str, as_of, col: str = "created_date") -> DataFrame:
    """Look-back window of a load mode (``historical`` 90 d, ``incremental`` 3 d),
    bound = midnight of ``as_of`` minus n days; unknown modes raise."""
    return filter_since(df, X.lookback_bound(mode, as_of), col)


def add_lineage(df: DataFrame, ingested_at, source: str, mode: str | None = None) -> DataFrame:
    """Lineage columns: one ``_ingested_at`` per load, the load mode, the source tag."""
    cols = {"_ingested_at": X.as_of_literal(ingested_at)}
    if mode is not None:
        X.validate_mode(mode)
        cols["_ingestion_mode"] = F.lit(mode)
    cols["_source"] = F.lit(source)
    return df.withColumns(cols)


def to_requests_raw(records: DataFrame, ingested_at, mode: str,
                    record_col: str = "record") -> DataFrame:
    """Parsed page records -> rows of ``requests_raw`` in declared order."""
    rows = project_records(records.select(record_col), record_col)
    rows = add_lineage(rows, ingested_at, C.SOURCE_REQUESTS, mode)
    return rows.select(*[c.name for c in schemas.REQUESTS_RAW])


def typed_requests(df: DataFrame) -> DataFrame:
    """Typed staging of the text columns: '' / NULL / bad text -> NULL."""
    return df.withColumns({
        "created_at": X.iso_to_ntz("created_date"),
        "closed_at": X.iso_to_ntz("closed_date"),
        "latitude_d": X.text_or_null("latitude").try_cast("double"),
        "longitude_d": X.text_or_null("longitude").try_cast("double"),
    })
