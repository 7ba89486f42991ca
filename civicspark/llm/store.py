"""Tables written once to the cluster's shared folder and read back.

A written table cuts the lineage: a lost executor re-reads files instead of
recomputing (or re-sampling) what came before, and several readers see the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from civicspark.session import shared_path


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and reread with its schema."""
    path = shared_path(df.sparkSession, f"llm-{name}")
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or it with underscores behind it, that no column in ``taken`` has (Spark ignores case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name
