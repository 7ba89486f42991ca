"""Pages of a stored order: a page reads the files that hold it, however deep it is.

``store`` sorts a table once by its order columns into files of bounded size and
writes a directory beside them: of each file the rows, the rows before it and its
least and greatest key.  ``page`` finds a page's files by row number, ``page_after``
those behind a key; both read the same few files' worth at any depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark import constants as C

ROWS_PER_FILE = 200_000


def _directory_schema(schema: T.StructType, order_cols: list[str]) -> T.StructType:
    key = T.StructType([schema[c] for c in order_cols])
    return T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
                         T.StructField("before", T.LongType()), T.StructField("lo", key), T.StructField("hi", key)])


def store(df: DataFrame, path: str, order_cols: list[str], rows_per_file: int = ROWS_PER_FILE,
          partitions: int | None = None) -> None:
    """Writes ``df`` in the order of ``order_cols`` (which should end in a unique key) with its directory."""
    spark = df.sparkSession
    ranges = [partitions] if partitions else []
    (df.repartitionByRange(*ranges, *order_cols).sortWithinPartitions(*order_cols).write
     .option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows"))
    key = F.struct(*order_cols)
    files = (spark.read.schema(df.schema).parquet(f"{path}/rows")
             .groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi")))
    # a row per file: the one place where an order over the whole table is needed
    before = F.sum("rows").over(Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    files.select("file", "rows", F.coalesce(before, F.lit(0)).cast("long").alias("before"), "lo", "hi") \
        .write.parquet(f"{path}/directory")


def directory(spark: SparkSession, path: str, schema: T.StructType, order_cols: list[str]) -> DataFrame:
    return spark.read.schema(_directory_schema(schema, order_cols)).parquet(f"{path}/directory")


def _rows(spark: SparkSession, path: str, schema: T.StructType, files: list) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/rows/{f['file']}" for f in files])


def page(spark: SparkSession, path: str, schema: T.StructType, order_cols: list[str], page_no: int,
         page_size: int = C.PAGE_SIZE) -> DataFrame:
    """Page ``page_no`` (from 0) in the stored order."""
    start = page_no * page_size
    files = (directory(spark, path, schema, order_cols)
             .filter((F.col("before") < start + page_size) & (F.col("before") + F.col("rows") > start))
             .select("file", "before").orderBy("before").collect())       # page_size / rows per file + 2 at most
    skip = start - files[0]["before"] if files else 0
    return _rows(spark, path, schema, files).orderBy(*order_cols).offset(skip).limit(page_size)


def page_after(spark: SparkSession, path: str, schema: T.StructType, order_cols: list[str], after: tuple,
               page_size: int = C.PAGE_SIZE) -> DataFrame:
    """The ``page_size`` rows behind the key ``after``: a reader that knows its last row needs no row number."""
    kinds = [schema[c].dataType for c in order_cols]
    key = F.struct(*[F.lit(v).cast(k).alias(c) for c, k, v in zip(order_cols, kinds, after)])
    behind = directory(spark, path, schema, order_cols).filter(F.col("hi") > key)
    first = behind.agg(F.min(F.col("before") + F.col("rows"))).first()[0]
    # the file that holds the key may have few rows behind it; the next ones make up a page
    files = [] if first is None else (behind.filter(F.col("before") < first + page_size).select("file").collect())
    return _rows(spark, path, schema, files).filter(F.struct(*order_cols) > key).orderBy(*order_cols).limit(page_size)
