"""Landing payloads -> rows.

Each feed lands JSON files in a directory (one file per page / document).
Files are read whole (``wholetext``) because a JSON array is not
splittable; a page is bounded (page size), so parallelism = number of
files.  Parsing is native (``from_json`` / ``parse_json``), never Python.

The parsers take a DataFrame with one JSON text column, so the same code
serves a batch read, a file stream and payloads built in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.scalars import zip_header

REQUEST_PAGE_SCHEMA = "array<map<string,string>>"
CENSUS_DOC_SCHEMA = "array<array<string>>"
FAIL_ON_MALFORMED = {"mode": "FAILFAST"}      # a broken page fails the load instead of vanishing


def read_payloads(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One row per landed file: ``value`` (whole text) and ``_file``."""
    reader = spark.readStream if stream else spark.read
    df = reader.format("text").option("wholetext", "true").load(path)
    return df.withColumn("_file", F.col("_metadata.file_path"))


def _parsed(text: Column, schema: str, what: str) -> Column:
    """The parsed payload; one that holds nothing to parse is an error, not an absence of rows."""
    blank = F.raise_error(F.lit(f"blank {what}")).cast(schema)
    return F.coalesce(F.from_json(text, schema, FAIL_ON_MALFORMED), blank)


def explode_request_pages(pages: DataFrame, text_col: str = "value") -> DataFrame:
    """Pages (JSON arrays of flat objects) -> one ``record`` map per element.
    Values stay text; a JSON null stays NULL; absent keys are absent.  A malformed
    or blank page fails the load (``operators.outcomes`` routes it aside instead)."""
    rec = F.explode(_parsed(F.col(text_col), REQUEST_PAGE_SCHEMA, "request page"))
    keep = [c for c in pages.columns if c != text_col]
    return pages.select(*keep, rec.alias("record"))


# numeric leaves of an observation document, read as JSON doubles
WEATHER_NUMBERS = (
    "coord struct<lat double, lon double>, "
    "main struct<temp double, feels_like double, temp_min double, temp_max double, "
    "pressure double, humidity double>, visibility double, "
    "wind struct<speed double, deg double>, clouds struct<`all` double>, "
    "rain struct<`1h` double>, snow struct<`1h` double>, dt double, "
    "sys struct<sunrise double, sunset double>")


def parse_weather_docs(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Nested observation documents -> ``doc`` VARIANT column plus ``num``, the
    numeric leaves parsed as JSON doubles.

    The VARIANT keeps the difference between an absent path (SQL NULL) and a
    JSON null.  It stores exact decimals, which have no negative zero, so
    numbers are read from the typed parse (``-0.0`` stays ``-0.0``, integers
    widen to double), falling back to the VARIANT for text-encoded numbers.

    The VARIANT is parsed inside a one-element ``explode`` (a Generate node):
    the ~40 path lookups downstream then read one parsed value per row.  As a
    plain projection the optimizer would substitute the parse into every
    pushed-down predicate, parsing each document once per lookup.  The typed
    parse stays a projection, so Catalyst prunes its schema to the numbers a
    query reads (and drops it when none are read)."""
    keep = [c for c in docs.columns if c != text_col]
    text = F.col(text_col)
    with_doc = docs.select(*keep, text, F.explode(F.array(F.parse_json(text))).alias("doc"))
    return with_doc.select(*keep, "doc", F.from_json(text, WEATHER_NUMBERS).alias("num"))


def explode_census_docs(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Header-plus-rows documents -> one row per data row with ``data``, the
    row keyed by the header (``dict(zip(header, row))``).  Element 0 is the
    header; a header-only document yields no rows; JSON numbers arrive as
    text.

    The zip happens inside the ``explode`` (a Generate node), so each row's
    map is built once; as a projection, filters pushed below it would rebuild
    the map once per predicate."""
    arr = _parsed(F.col(text_col), CENSUS_DOC_SCHEMA, "survey document")
    keep = [c for c in docs.columns if c != text_col]
    parsed = docs.select(*keep, arr.alias("_doc"))
    header = F.get("_doc", F.lit(0))
    rows = F.slice(F.col("_doc"), 2, F.greatest(F.size("_doc") - 1, F.lit(0)))
    # a document without a header row is no survey document
    rows = F.when(F.size("_doc") == 0, F.raise_error(F.lit("survey document without a header")))\
        .otherwise(rows)
    return parsed.select(*keep, F.explode(F.transform(rows, lambda r: zip_header(header, r)))
                         .alias("data"))
