"""Ordered paging, end-of-feed detection and load-batch accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark.operators.ordered import global_index

# Up to this many rows (offset + page) a page is cut with a bounded top-k per
# task; deeper pages use the distributed global index instead.
TOP_K_ROWS = 1_000_000


def page_slice(df: DataFrame, order_cols: list[str], page_no: int,
               page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Page ``page_no`` (0-based) of ``df`` in ``order_cols`` order: ORDER BY ...
    OFFSET page_no*size LIMIT size.  ``order_cols`` should end in a unique key so
    pages partition the input."""
    offset = page_no * page_size
    if offset + page_size <= TOP_K_ROWS:
        return df.orderBy(*order_cols).offset(offset).limit(page_size)
    idx = global_index(df, order_cols, "_idx")
    return idx.filter((F.col("_idx") >= offset) & (F.col("_idx") < offset + page_size)).drop("_idx")


def page_report(df: DataFrame, order_cols: list[str], key_col: str,
                page_size: int = C.PAGE_SIZE) -> DataFrame:
    """One row per page: ``page_no``, ``n_rows``, first/last key, ``is_last``.
    The last page is the first short page; a feed that is an exact multiple of
    the page size ends with its last full page (the reader then costs one
    extra, empty fetch: ``extra_fetch``)."""
    idx = global_index(df, order_cols, "_idx")
    total = df.select(F.count(F.lit(1))).scalar()
    pages = idx.groupBy((F.col("_idx") / F.lit(page_size)).cast("long").alias("page_no")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by(key_col, "_idx").alias("first_key"),
        F.max_by(key_col, "_idx").alias("last_key"))
    last = (F.col("page_no") + 1) * page_size >= total
    return pages.withColumns({
        "is_last": last,
        "extra_fetch": last & (F.col("n_rows") == page_size),
    })


def batch_report(df: DataFrame, order_cols: list[str], key_col: str,
                 batch_size: int = C.INSERT_BATCH_SIZE) -> DataFrame:
    """Load batches of ``batch_size`` rows in feed order: 1-based ``batch_no``,
    ``n_rows``, first/last key and the running total after the batch.  All
    batches but the last are full, so the running total is closed-form and
    needs no window over the batch table."""
    idx = global_index(df, order_cols, "_idx")
    b = idx.groupBy(((F.col("_idx") / F.lit(batch_size)).cast("long") + 1).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by(key_col, "_idx").alias("first_key"),
        F.max_by(key_col, "_idx").alias("last_key"))
    return b.withColumn("running_total", (F.col("batch_no") - 1) * batch_size + F.col("n_rows"))
