"""Table writes: append loads, keyed upsert, catalog DDL.

Commit semantics: a Spark write job commits its files at job commit, so a
failed load leaves the table as it was (all-or-nothing per load).  The
upsert stages its merged partitions in the shared folder first (cutting the
read-while-overwrite cycle) and then replaces only the touched partitions
(``partitionOverwriteMode=dynamic``), which are swapped in at job commit.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.operators.quality import conform
from civicspark.operators.upsert import assert_unique_keys, merge
from civicspark.session import shared_path


def create_table(spark: SparkSession, name: str, contract_name: str,
                 location: str | None = None, partitioned_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` in the session catalog with declared
    VARCHAR lengths (enforced on table inserts), defaults and comment."""
    contract, comment = schemas.CONTRACTS[contract_name]
    spark.sql(schemas.create_table_ddl(name, contract, comment, location, partitioned_by))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None,
           max_records_per_file: int | None = None) -> int:
    """Append ``df`` to the Parquet table at ``path``; returns the number of rows
    written, observed during the write (no second pass)."""
    obs = Observation("loaded")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)
    return int(obs.get["n"])


def load_feed(df: DataFrame, path: str, contract_name: str,
              max_records_per_file: int | None = None,
              partition_by: list[str] | None = None) -> int:
    """Conform to the table contract (keeping any partition columns) and
    append.  Empty input touches nothing and returns 0."""
    if df.isEmpty():
        return 0
    contract, _ = schemas.CONTRACTS[contract_name]
    return append(conform(df, contract, keep=partition_by), path, partition_by=partition_by,
                  max_records_per_file=max_records_per_file)


def read_table_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def upsert(source: DataFrame, path: str, keys: list[str], update_cols: list[str],
           partition_col: str | None = None) -> int:
    """MERGE ``source`` into the Parquet table at ``path`` on ``keys``.

    The source is staged first (written once to the shared folder, its rows
    counted during that write), so the key check, the broadcast decision and
    the merge read the staged copy instead of recomputing the source plan.
    Only target partitions that the source touches are read (a semi-join on
    the partition column, which becomes partition pruning) and rewritten.
    Returns the number of staged source rows."""
    spark = source.sparkSession
    staged_path = shared_path(spark, "upsert-source")
    n = append(source, staged_path)
    # with the declared schema: partition values and empty columns are not inferred anew
    staged = spark.read.schema(source.schema).parquet(staged_path)
    assert_unique_keys(staged, keys)
    target = read_table_or_empty(spark, path, source.schema).select(*source.columns)
    if partition_col:
        # null-safe: the overwrite below replaces the null partition too, so it has to be read
        touched = staged.select(F.col(partition_col).alias("_touched")).distinct()
        target = target.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
    merged = merge(target, staged, keys, update_cols, check_unique=False, source_rows=n)
    out_path = shared_path(spark, "upsert-stage")
    w = merged.write.mode("overwrite").format("parquet")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(out_path)
    out = spark.read.schema(source.schema).parquet(out_path).select(*source.columns)
    w2 = out.write.mode("overwrite").format("parquet")
    if partition_col:
        w2 = w2.partitionBy(partition_col).option("partitionOverwriteMode", "dynamic")
    w2.save(path)
    return n
