"""Parquet tables of the shared test data (and any table laid out the same way)."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# One DataFrame per (session, path), as a catalog table would be: the files are
# listed and the footers read once, not on every query.  Inputs are immutable;
# call ``forget_tables`` after files change (as REFRESH TABLE would).
_HANDLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    handles = _HANDLES.setdefault(spark, {})
    if path not in handles:
        handles[path] = spark.read.parquet(path)
    return handles[path]


def forget_tables(spark: SparkSession) -> None:
    _HANDLES.pop(spark, None)


def read_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in (names or TABLES)}
