"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast only after checking the size (a ``limit(max_rows+1)`` count);
    otherwise leave the join to a shuffle (or to AQE's runtime conversion)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def spread(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Hash-repartition on ``key_cols`` only when the input has fewer partitions
    than the cluster has cores (e.g. one small file), so per-row CPU work is
    parallel.  On large inputs the scan already has enough splits and the
    frame is returned unchanged (no shuffle)."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= cores:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. Spark Connect): leave as is
        return df
    return df.repartition(cores, *key_cols)
