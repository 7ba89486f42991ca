"""Tables published in versions: a load is visible as a whole or not at all.

A table folder holds

* ``data/load=<id>/[<partition>=<value>/]``  Parquet files, never changed once written;
* ``<kind>/load=<id>/``  tables published beside the rows: key index, ledger of files, rejects;
* ``_manifests/<id>/``   one row per live file of a version: path, partition, rows,
  least and greatest key; written by Spark;
* ``_commits/<number>``  the version's pointer: a small JSON text naming its manifest.

A load first writes its files, then the manifest, then the pointer, by a rename
that fails if the number is taken.  Only the rename publishes: a load that dies
before it leaves files that no version names, and readers keep what they had.  Of
two loads that start from one version, the second gets ``Conflict`` and starts
again from the new one.  The pointer also carries what was loaded (rows, source
files, a stream's batch), so that data and bookkeeping are published together.

``upsert`` rewrites only the files that hold a key of the source:

1. partitions that may hold them: the source's own and, where a key's partition
   may change, those the key index names.  The index has a row for each key and
   partition a load put together, in buckets of the key's hash, and only the
   buckets of the source's keys are read;
2. of their files, those whose key range meets the source's (from the manifest);
3. of these, by reading the key columns alone, those with a key of the source.

Readers get the list of live files, as Spark's own file index would hold it; the
manifest itself stays a table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.operators.upsert import BROADCAST_SOURCE_ROWS, assert_unique_keys, merge
from civicspark.session import shared_path

MANIFEST = ("kind string, file string, part string, rows long, lo string, hi string")
INDEX_BUCKETS = 64
DATA, INDEX = "data", "index"
BATCHES = "batches"           # of a version's record: stream -> last batch published


class Conflict(RuntimeError):
    """Another load published the version this one wanted to be."""


@dataclass(frozen=True)
class Version:
    number: int
    manifest: str | None = None
    info: dict = field(default_factory=dict)


def struct(spark: SparkSession, ddl: str) -> T.StructType:
    """A schema from its DDL text."""
    return spark.createDataFrame([], ddl).schema


# --- files of the folder ------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, to_path = _fs(spark, folder)
    if not fs.exists(to_path(folder)):
        return []
    return [s.getPath().getName() for s in fs.listStatus(to_path(folder))]


def _read_text(spark: SparkSession, path: str) -> str:
    fs, to_path = _fs(spark, path)
    stream = fs.open(to_path(path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, number: int, text: str) -> None:
    """The pointer of version ``number``, whole or not at all; fails if there is one."""
    fs, to_path = _fs(spark, path)
    final, temporary = f"{path}/_commits/{number:012d}", f"{path}/_commits/.{uuid.uuid4().hex}"
    stream = fs.create(to_path(temporary), False)
    stream.write(text.encode())
    stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(to_path(temporary), to_path(final), options)
    except Py4JJavaError as e:
        fs.delete(to_path(temporary), False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {number} of {path} was published by another load") from e
        raise


# --- versions ----------------------------------------------------------------------------

def latest(spark: SparkSession, path: str) -> Version:
    """The newest version; number 0 without a manifest for a table that has none."""
    path = path.rstrip("/")
    numbers = [int(n) for n in _names(spark, f"{path}/_commits") if n.isdigit()]
    return at_version(spark, path, max(numbers)) if numbers else Version(0)


def at_version(spark: SparkSession, path: str, number: int) -> Version:
    said = json.loads(_read_text(spark, f"{path.rstrip('/')}/_commits/{number:012d}"))
    return Version(number, said["manifest"], said["info"])


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version: what was done, rows loaded, and the rest of the pointer's record."""
    folder = f"{path.rstrip('/')}/_commits"
    if not any(n.isdigit() for n in _names(spark, folder)):
        return spark.createDataFrame([], "version long, operation string, rows long, rejected long, info string")
    said = spark.read.text(f"{folder}/0*", wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).cast("long").alias("version"),
        F.get_json_object("value", "$.info").alias("info"))
    value = lambda key, kind: F.get_json_object("info", f"$.{key}").cast(kind).alias(key)
    return said.select("version", value("operation", "string"), value("rows", "long"), value("rejected", "long"), "info")


def files(spark: SparkSession, path: str, version: Version | None = None, kind: str = DATA) -> DataFrame:
    """The manifest: live files of a version (default: the newest)."""
    version = version or latest(spark, path)
    if version.manifest is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/{version.manifest}").filter(F.col("kind") == kind)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """What each version wrote, by partition: ``version, chunk_no`` (from 1), ``part, files, rows, first_key,
    last_key, total_rows`` (of the version, up to the chunk) and ``is_last``.

    From the manifests alone, no row is read.  A file counts for the first version that lists it, so a
    version that rewrites files counts them as its own.  Chunks are in order of the partition's text, a
    null one first; a version that wrote no data file has none."""
    path = path.rstrip("/")
    if not any(n.isdigit() for n in _names(spark, f"{path}/_commits")):
        listed = spark.createDataFrame([], f"version long, {MANIFEST}")
    else:
        commits = spark.read.text(f"{path}/_commits/0*", wholetext=True).select(
            F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).cast("long").alias("version"),
            F.element_at(F.split(F.get_json_object("value", "$.manifest"), "/"), -1).alias("manifest"))
        # the manifests that a version names, not those of loads that were never published
        listed = (spark.read.schema(MANIFEST).parquet(f"{path}/_manifests/*")
                  .withColumn("manifest", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
                  .join(commits, "manifest"))
    added = (listed.filter(F.col("kind") == DATA).groupBy("file", "part", "rows", "lo", "hi")
             .agg(F.min("version").alias("version")))
    parts = added.groupBy("version", "part").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("lo").alias("first_key"),
        F.max("hi").alias("last_key"))
    # a row per partition of a version
    order = Window.partitionBy("version").orderBy(F.col("part").asc_nulls_first())
    return parts.select(
        "version", F.row_number().over(order).cast("long").alias("chunk_no"), "part", "files", "rows", "first_key",
        "last_key", F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("total_rows"),
        F.lead("version").over(order).isNull().alias("is_last"))


def commit(spark: SparkSession, path: str, base: Version, manifest: DataFrame, info: dict) -> Version:
    """Publishes ``manifest`` as the version after ``base``.  The last batch of each stream is
    carried from version to version."""
    path = path.rstrip("/")
    info = {**info, BATCHES: {**base.info.get(BATCHES, {}), **info.get(BATCHES, {})}}
    name = f"_manifests/{uuid.uuid4().hex}"
    manifest.select(*[c.split()[0] for c in MANIFEST.split(", ")]).write.parquet(f"{path}/{name}")
    new = Version(base.number + 1, name, info)
    _publish(spark, path, new.number, json.dumps({"manifest": name, "info": info}))
    return new


def create(spark: SparkSession, path: str, schema: T.StructType, comment: str = "") -> Version:
    """Create-if-absent: an empty first version that declares the columns and a comment."""
    base = latest(spark, path)
    if base.number:
        return base
    try:
        return commit(spark, path, base, spark.createDataFrame([], MANIFEST),
                      {"operation": "create", "rows": 0, "schema": schema.json(), "comment": comment})
    except Conflict:                       # another load created it
        return latest(spark, path)


def declared_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns a created table declares."""
    return T.StructType.fromJson(json.loads(at_version(spark, path, 1).info["schema"]))


# --- reading -----------------------------------------------------------------------------

def _with_load(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("load", T.StringType())])


def read_files(spark: SparkSession, path: str, schema: T.StructType, names: list[str], folder: str = DATA) -> DataFrame:
    """Rows of the named files, with partition columns from their paths and ``load``."""
    if not names:
        return spark.createDataFrame([], _with_load(schema))
    root = f"{path.rstrip('/')}/{folder}"
    return (spark.read.schema(_with_load(schema)).option("basePath", root)
            .parquet(*[f"{root}/{n}" for n in names]))


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, version: Version | None = None,
         kind: str = DATA) -> DataFrame:
    """The table (or one beside it) as of a version (default: the newest); empty if there is none.
    Later loads do not change what this frame reads.  A created table knows its columns."""
    schema = schema or declared_schema(spark, path)
    names = [r["file"] for r in files(spark, path, version, kind).select("file").toLocalIterator()]
    return read_files(spark, path, schema, names, kind).select(*schema.names)


# --- writing -----------------------------------------------------------------------------

def _file_name(folder: str) -> Column:
    """A row's file as the manifest names it: below ``folder``, as it is on disk (the metadata column
    has it percent-encoded, where a plus is a plus)."""
    whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.concat(F.lit("load="), F.element_at(F.split(whole, f"/{folder}/load="), -1))


def _written_files(spark, path: str, folder: str, load: str, schema: T.StructType, part: str | None,
                   key: str | None) -> DataFrame:
    """Manifest rows of a load's files; reads the partition and key columns alone."""
    root = f"{path}/{folder}"
    rows = spark.read.schema(_with_load(schema)).option("basePath", root).parquet(f"{root}/load={load}")
    text = F.col(key).cast("string") if key else F.lit(None).cast("string")
    value = F.col(part).cast("string") if part else F.lit(None).cast("string")
    return (rows.groupBy(_file_name(folder).alias("file"), value.alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(text).alias("lo"), F.max(text).alias("hi"))
            .select(F.lit(folder).alias("kind"), "file", "part", "rows", "lo", "hi"))


def _write(df: DataFrame, path: str, folder: str, part: str | None, max_records_per_file: int | None = None) -> str:
    load = uuid.uuid4().hex
    w = df.write.format("parquet")
    if part:
        w = w.partitionBy(part)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(f"{path}/{folder}/load={load}")
    return load


def _index_of(rows: DataFrame, keys: list[str], partition_col: str) -> DataFrame:
    """Key, partition and bucket of rows whose key is known."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return rows.filter(known).select(*keys, F.col(partition_col).cast("string").alias("part"),
                                     F.pmod(F.hash(*keys), F.lit(INDEX_BUCKETS)).cast("int").alias("bucket"))


def _index_schema(schema: T.StructType, keys: list[str]) -> T.StructType:
    return T.StructType([*[schema[k] for k in keys], T.StructField("part", T.StringType()),
                         T.StructField("bucket", T.IntegerType())])


def append(df: DataFrame, path: str, partition_col: str | None = None, keys: list[str] | None = None,
           index: bool = False, info: dict | None = None, base: Version | None = None,
           max_records_per_file: int | None = None, beside: dict[str, DataFrame] | None = None) -> Version:
    """Publishes ``df`` as an addition.  ``keys`` gives the manifest key ranges (first key) and, with
    ``index``, the key index its partitions.  ``beside``: rows for the tables beside it, in the same
    version.  An empty frame with nothing beside it publishes nothing."""
    spark, path = df.sparkSession, path.rstrip("/")
    base = base or latest(spark, path)
    seen = Observation("appended")
    load = _write(df.observe(seen, F.count(F.lit(1)).alias("n")), path, DATA, partition_col, max_records_per_file)
    n = int(seen.get["n"])
    added = _written_beside(spark, path, beside)
    if not n and added is None:
        return base
    if n:
        rows = _written_files(spark, path, DATA, load, df.schema, partition_col, keys[0] if keys else None)
        added = rows if added is None else rows.unionByName(added)
    if index and n:
        stored = read_load(spark, path, df.schema, load)
        added = added.unionByName(_add_to_index(stored, path, keys, partition_col))
    manifest = _all_files(spark, path, base).unionByName(added)
    return commit(spark, path, base, manifest, {"operation": "append", "rows": n, **(info or {})})


def _written_beside(spark, path: str, beside: dict[str, DataFrame] | None) -> DataFrame | None:
    """Writes the rows that go beside a load; their manifest rows, None if there are none."""
    out = None
    for kind, rows in (beside or {}).items():
        load = _write(rows, path, kind, None)
        new = _written_files(spark, path, kind, load, rows.schema, None, None)
        out = new if out is None else out.unionByName(new)
    return out


def read_load(spark: SparkSession, path: str, schema: T.StructType, load: str) -> DataFrame:
    root = f"{path.rstrip('/')}/{DATA}"
    return spark.read.schema(_with_load(schema)).option("basePath", root).parquet(f"{root}/load={load}")


def _all_files(spark, path: str, version: Version) -> DataFrame:
    if version.manifest is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/{version.manifest}")


def _add_to_index(rows: DataFrame, path: str, keys: list[str], partition_col: str) -> DataFrame:
    """Writes the index rows of ``rows`` and returns their manifest rows."""
    entries = _index_of(rows, keys, partition_col).distinct()
    load = _write(entries.repartition("bucket"), path, INDEX, "bucket")
    return _written_files(rows.sparkSession, path, INDEX, load, _index_schema(rows.schema, keys), "bucket", keys[0])


def _partitions_of(spark, path: str, base: Version, source: DataFrame, keys: list[str], schema: T.StructType,
                   partition_col: str | None, index: bool) -> DataFrame:
    """``part``: every partition that may hold a key of the source."""
    own = source.select((F.col(partition_col).cast("string") if partition_col else F.lit(None).cast("string"))
                        .alias("part")).distinct()
    if not index:
        return own
    buckets = [r[0] for r in _index_of(source, keys, partition_col).select("bucket").distinct().collect()]  # INDEX_BUCKETS at most
    live = files(spark, path, base, INDEX).filter(F.col("part").isin([str(b) for b in buckets])) if buckets else None
    if live is None:
        return own
    entries = read_files(spark, path, _index_schema(schema, keys),
                         [r["file"] for r in live.select("file").toLocalIterator()], INDEX)
    return own.unionByName(entries.join(source.select(*keys), keys, "left_semi").select("part")).distinct()


def files_with_keys(spark: SparkSession, path: str, base: Version, source: DataFrame, keys: list[str],
                    schema: T.StructType, partition_col: str | None = None, index: bool = False) -> list[str]:
    """Names of the live files that hold a key of ``source`` (steps 1 to 3 above)."""
    parts = _partitions_of(spark, path, base, source, keys, schema, partition_col, index).select(
        F.col("part").alias("wanted"))
    span = source.agg(F.min(F.col(keys[0]).cast("string")).alias("lo"), F.max(F.col(keys[0]).cast("string")).alias("hi")).first()
    if span["lo"] is None:
        return []
    near = (files(spark, path, base)
            .filter(F.col("lo").isNotNull() & (F.col("hi") >= span["lo"]) & (F.col("lo") <= span["hi"])))
    if partition_col:
        near = near.join(parts, F.col("part").eqNullSafe(F.col("wanted")), "left_semi")
    names = [r["file"] for r in near.select("file").toLocalIterator()]
    if not names:
        return []
    held = read_files(spark, path, schema, names).select(*keys, _file_name(DATA).alias("file"))
    hit = held.join(source.select(*keys), keys, "left_semi").select("file").distinct()
    return [r["file"] for r in hit.toLocalIterator()]


def replace_keys(source: DataFrame, path: str, keys: list[str], partition_col: str | None = None, index: bool = False,
                 info: dict | None = None, base: Version | None = None, drop: tuple[str, ...] = ()) -> Version:
    """Publishes the table with all rows of the source's keys replaced by the source's rows, of which a
    key may have several.  Only files that hold such a key are rewritten.  Keys are not null.  Tables
    beside it named in ``drop`` are empty in the new version."""
    spark, path = source.sparkSession, path.rstrip("/")
    base = base or latest(spark, path)
    staged_path, seen = shared_path(spark, "replace-source"), Observation("staged")
    source.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged_path)
    n = int(seen.get["n"])
    staged = spark.read.schema(source.schema).parquet(staged_path)
    touched = files_with_keys(spark, path, base, staged, keys, source.schema, partition_col, index) if n else []
    kept = read_files(spark, path, source.schema, touched).select(*source.columns).join(
        staged.select(*keys).distinct(), keys, "left_anti").select(*source.columns)
    load = _write(kept.unionByName(staged), path, DATA, partition_col)
    added = _written_files(spark, path, DATA, load, source.schema, partition_col, keys[0])
    if index and n:
        added = added.unionByName(_add_to_index(staged, path, keys, partition_col))
    old = _all_files(spark, path, base).filter(~F.col("kind").isin(*drop) if drop else F.lit(True))
    if touched:
        old = old.join(spark.createDataFrame([(t,) for t in touched], "file string"), "file", "left_anti")
    return commit(spark, path, base, old.select(*added.columns).unionByName(added),
                  {"operation": "replace", "rows": n, "files_rewritten": len(touched), **(info or {})})


def upsert(source: DataFrame, path: str, keys: list[str], update_cols: list[str], partition_col: str | None = None,
           index: bool = False, info: dict | None = None, base: Version | None = None,
           broadcast_rows: int = BROADCAST_SOURCE_ROWS, beside: dict[str, DataFrame] | None = None) -> Version:
    """Publishes the table with ``source`` merged into it on ``keys`` (see ``operators.upsert``).

    With ``index`` a key may change its partition (name ``partition_col`` in ``update_cols`` then):
    the old row is found wherever it is.  Without, a key is looked for in the source's partitions."""
    spark, path = source.sparkSession, path.rstrip("/")
    base = base or latest(spark, path)
    staged_path, seen = shared_path(spark, "upsert-source"), Observation("staged")
    source.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged_path)
    n = int(seen.get["n"])
    if not n:
        return append(source.limit(0), path, partition_col, info=info, base=base, beside=beside)
    staged = spark.read.schema(source.schema).parquet(staged_path)
    assert_unique_keys(staged, keys)
    touched = files_with_keys(spark, path, base, staged, keys, source.schema, partition_col, index)
    target = read_files(spark, path, source.schema, touched).select(*source.columns)
    merged = merge(target, staged, keys, update_cols, check_unique=False, source_rows=n, broadcast_rows=broadcast_rows)
    load = _write(merged, path, DATA, partition_col)
    added = _written_files(spark, path, DATA, load, source.schema, partition_col, keys[0])
    if index:
        added = added.unionByName(_add_to_index(staged, path, keys, partition_col))
    more = _written_beside(spark, path, beside)
    added = added if more is None else added.unionByName(more)
    old = _all_files(spark, path, base)
    if touched:
        gone = spark.createDataFrame([(t,) for t in touched], "file string")
        old = old.join(gone, "file", "left_anti")
    return commit(spark, path, base, old.select(*added.columns).unionByName(added),
                  {"operation": "upsert", "rows": n, "files_rewritten": len(touched), **(info or {})})
