"""Landed files a table has not consumed yet.

A landing folder holds one file per page or document, in ``load_date=<day>/``
folders where the feed lands them so.  The ledger is a table beside the target
(``ledger``): path, size and time of every file a load consumed, published in
the same version as the rows that came from it.  A run lists the folder (from
``since`` on only the days' folders), takes away what the ledger holds, and
reads only the rest.  A file that was replaced has another time or size and
counts as new.

Spark's readers leave out files of zero bytes; they come from the listing, so
an empty payload is an arrival too.
"""

from __future__ import annotations

import re
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.sinks import versions

LEDGER = "ledger"
ARRIVED = "path string, size long, modified timestamp"
DAY = "load_date"


def _listing(spark: SparkSession, landing_dir: str, since: str | None):
    """Scan of the landed files without their content, with the days' folders pruned."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(landing_dir))
    if since is not None:
        if DAY not in files.columns:
            raise ValueError(f"a bound on the landing day needs {DAY}=<day> folders")
        files = files.filter(F.col(DAY) >= F.lit(since).cast(files.schema[DAY].dataType))
    return files


def _named_day(path: str) -> str | None:
    for part in path.split("/"):
        if part.startswith(f"{DAY}="):
            return part.removeprefix(f"{DAY}=")
    return None


def landed(spark: SparkSession, landing_dir: str, since: str | None = None) -> DataFrame:
    """``path, size, modified`` of the landed files, empty ones included (without a time)."""
    scan = _listing(spark, landing_dir, since)
    full = scan.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    # names only, as the reader's own file index holds them; the folders are those of the wanted days
    names = [n for n in scan.inputFiles() if since is None or (_named_day(n) or since) >= since]
    every = spark.createDataFrame([(n,) for n in names], "name string")
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    empty = (every.select(plain(F.col("name")).alias("path"))
             .join(full.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")), "path", "left_anti")
             .select("path", F.lit(0).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified")))
    return full.unionByName(empty)


def arrivals(spark: SparkSession, landing_dir: str, table_path: str, since: str | None = None,
             base: versions.Version | None = None, again: bool = False) -> DataFrame:
    """Landed files that the table's ledger does not hold (all of them with ``again``)."""
    files = landed(spark, landing_dir, since)
    if again:
        return files
    ledger = versions.read(spark, table_path, versions.struct(spark, ARRIVED), base, LEDGER)
    same = [files["path"] == ledger["path"], files["size"] == ledger["size"],
            files["modified"].eqNullSafe(ledger["modified"])]
    return files.join(ledger, same, "left_anti")


def _plain(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def _roots(spark: SparkSession, landing_dir: str, full: list[str], empty: list[str]) -> list[str]:
    """What to read for the files ``full``: a folder whose files are all wanted stands for them, as the reader
    lists folders faster than files.  A folder with a file beyond ``full`` and ``empty`` (consumed before, or
    landed since) or with folders inside gives its files one by one."""
    wanted, listed = defaultdict(set), defaultdict(set)
    for n in (*full, *empty):
        wanted[n.rpartition("/")[0]].add(_plain(n))
    folders = sorted({n.rpartition("/")[0] for n in full})
    for n in spark.read.format("binaryFile").option("basePath", landing_dir).load(folders).inputFiles():
        n = _plain(unquote(n))
        listed[n.rpartition("/")[0]].add(n)
    inside = {f.rpartition("/")[0] for f in listed}
    whole = {f for f in folders if listed[_plain(f)] == wanted[f] and _plain(f) not in inside}
    return [*sorted(whole), *(n for n in full if n.rpartition("/")[0] not in whole)]


def payloads(spark: SparkSession, landing_dir: str, files: DataFrame) -> DataFrame:
    """Text of the files: ``path, modified, value`` and the folder's partition columns.  An empty
    file has an empty text."""
    names = [(r["path"], r["size"]) for r in files.select("path", "size").toLocalIterator()]
    parts = [c for c in spark.read.format("binaryFile").load(landing_dir).columns
             if c not in ("path", "modificationTime", "length", "content")]
    full = [n for n, size in names if size]
    empty = [n for n, size in names if not size]
    schema = ", ".join(["path string", "modified timestamp", "value string", *[f"`{p}` string" for p in parts]])
    out = spark.createDataFrame([(n, None, "", *[_part(n, p) for p in parts]) for n in empty], schema)
    if full:
        scan = lambda roots: spark.read.format("binaryFile").option("basePath", landing_dir).load(roots)
        read = scan(_roots(spark, landing_dir, full, empty))
        if not {_plain(unquote(n)) for n in read.inputFiles()} <= {_plain(n) for n, _ in names}:
            read = scan(full)                                # a file landed in one of the folders meanwhile
        out = out.unionByName(read.select("path", F.col("modificationTime").alias("modified"),
                                          F.decode("content", "UTF-8").alias("value"),
                                          *[F.col(p).cast("string").alias(p) for p in parts]))
    return out


def _part(path: str, name: str) -> str | None:
    for part in path.split("/"):
        if part.startswith(f"{name}="):
            return part.removeprefix(f"{name}=")
    return None
