"""Latest row per key and Type 2 slowly changing dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.operators.ordered import shift_within


def latest_by_key(df: DataFrame, key: list[str], order_cols: list[str]) -> DataFrame:
    """Newest row per key by ``order_cols`` (e.g. ``_ingested_at`` then a
    tie-break).  ``max_by`` is combined map-side, so a hot key costs one
    partial row per task, not a sort of all its rows."""
    rest = [c for c in df.columns if c not in key]
    agg = df.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order_cols])).alias("_row"))
    return agg.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


FEED_ORDER = ["_file_time", "_file", "_position"]      # where a row stood in the landed feed


def latest_request_rows(rows: DataFrame) -> DataFrame:
    """Latest row per request by load time.  Rows of one load go by their place in the feed where
    the table carries it (file time, file, position in the page), so a reopened request ends open;
    without it closed goes before open, then by closing time.  A missing or empty ``unique_key``
    names no request: such rows are kept as they are."""
    key = F.col("unique_key")
    named = F.coalesce(key != "", F.lit(False))
    closed = (F.coalesce("closed_date", F.lit("")) != "") | (F.lower(F.coalesce("status", F.lit(""))) == "closed")
    order = FEED_ORDER if set(FEED_ORDER) <= set(rows.columns) else ["_closed", "closed_date", "status"]
    # one pass: a row without a key is a group of its own
    alone = F.when(~named, F.monotonically_increasing_id())
    latest = latest_by_key(rows.withColumns({"_closed": closed, "_alone": alone}), ["unique_key", "_alone"],
                           ["_ingested_at", *order])
    return latest.select(*rows.columns)


def _window_shift(df: DataFrame, key: list[str], order_cols: list[str], value_cols: list[str],
                  direction: str) -> DataFrame:
    """``shift_within`` as a plain window: for keys whose group size is bounded
    by construction (e.g. one row per borough and survey year)."""
    w = Window.partitionBy(*key).orderBy(*order_cols)
    fn = F.lag if direction == "prev" else F.lead
    out = df.withColumns({f"{direction}_{v}": fn(v).over(w) for v in value_cols})
    return out.withColumn(f"{direction}__exists", fn(F.lit(True)).over(w).isNotNull())


def scd2(df: DataFrame, key: list[str], order_cols: list[str], tracked: list[str],
         valid_from: str, skew_safe: bool = True) -> DataFrame:
    """Type 2 versions: a new version starts when any tracked column differs
    (NULL-safe) from the previous row of the key; unchanged rows collapse.
    Output: key, tracked, ``valid_from``, ``valid_to`` (next version's start,
    NULL when open) and ``is_current``.

    ``skew_safe`` (default) cuts a hot key across tasks (``shift_within``);
    pass ``False`` only when a key's rows are bounded by construction."""
    shift = shift_within if skew_safe else _window_shift
    prev = shift(df.select(*key, *order_cols, *tracked), key, order_cols, tracked, "prev")
    changed = reduce(lambda a, b: a | b,
                     [~F.col(c).eqNullSafe(F.col(f"prev_{c}")) for c in tracked],
                     ~F.col("prev__exists"))
    starts = prev.filter(changed).select(*key, *order_cols, *tracked)
    nxt = shift(starts, key, order_cols, [valid_from], "next")
    return nxt.select(
        *key, *tracked,
        F.col(valid_from).alias("valid_from"),
        F.col(f"next_{valid_from}").alias("valid_to"),
        (~F.col("next__exists")).alias("is_current"),
    )


def scd2_merge(dimension: DataFrame, rows: DataFrame, key: list[str], at: str, tracked: list[str]) -> DataFrame:
    """The versions of the keys in ``rows`` after ``rows`` (one per key and ``at``) were added to the
    stored ``dimension`` (``empty_dimension`` at first); other keys are not read beyond their key.

    A stored version names the ``observed`` points it covers, so a point that comes late, or comes again
    with other values, splits a version or closes a gap exactly as a build from all rows would: any
    order of loads ends in the same dimension.  A key's points are bounded by construction (survey
    years), so its versions are rebuilt in one window."""
    seen = dimension.join(rows.select(*key).distinct(), key, "left_semi")
    before = seen.select(*key, F.explode("observed").alias(at), *tracked)
    points = before.join(rows.select(*key, at), [*key, at], "left_anti").unionByName(rows.select(*key, at, *tracked))
    w = Window.partitionBy(*key).orderBy(at)
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in tracked])
    starts = F.when(F.row_number().over(w) == 1, True).otherwise(differs)
    numbered = points.withColumn("_starts", starts).withColumn("_nth", F.count_if("_starts").over(w))
    versions = numbered.groupBy(*key, "_nth").agg(*[F.min_by(c, at).alias(c) for c in tracked], F.min(at).alias("valid_from"),
                                                  F.sort_array(F.collect_list(at)).alias("observed"))
    after = F.lead("valid_from").over(Window.partitionBy(*key).orderBy("_nth"))
    return versions.withColumn("valid_to", after).select(
        *key, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "observed")
