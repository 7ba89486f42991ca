"""Order-dependent operators that stay distributed under skew.

``global_index`` numbers rows in a total order without a one-partition
window: the frame is range-partitioned on the order (the partitioner
samples keys, so even a hot value is cut across partitions when the order
ends in a unique tie-break), each partition is sorted, rows get their
position inside the partition, and a tiny table of per-partition counts
(at most one row per partition, so its broadcast is bounded by the
partition count) turns positions into global offsets.

``shift_within`` is ``lag``/``lead`` per key.  A plain window would put
every row of a hot key into one task.  Here the rows are range-partitioned
on (key, order); the window runs per (key, range partition), whose size is
bounded by the partition size, and the first/last row of each slice is
patched from the neighbouring slice of the same key (a boundary table with
at most one row per key and partition).

The range-partitioned frame is read twice (rows, and the per-partition
summary).  Its partition ids must agree between the two reads, but a range
partitioner samples its input in arrival order, which after a shuffle is not
repeatable.  So the frame is cut with a reliable ``checkpoint()`` into the
shared checkpoint folder: both reads see the same files, and a lost executor
re-reads them instead of re-sampling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.session import ensure_checkpoint_dir


def _by_range(df: DataFrame, cols: list[str], n_partitions: int | None) -> DataFrame:
    """Range partitioning; without an explicit count AQE sizes the partitions
    (contiguous ranges merged up to the advisory size, so ranges stay ordered).
    Partition ids are read after the exchange and frozen by the checkpoint."""
    return df.repartitionByRange(n_partitions, *cols) if n_partitions else df.repartitionByRange(*cols)


def _freeze(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def global_index(df: DataFrame, order_cols: list[str], index_col: str = "_idx",
                 n_partitions: int | None = None) -> DataFrame:
    """Adds ``index_col`` = 0-based position of the row in ``order_cols`` order.
    ``order_cols`` must be a total order (end with a unique key)."""
    ranged = (_by_range(df, order_cols, n_partitions).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ranged = _freeze(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # ``offsets`` has one row per range partition: a bounded broadcast
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, F.col("_off") + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def shift_within(df: DataFrame, key: list[str], order_cols: list[str], value_cols: list[str],
                 direction: str = "prev", prefix: str | None = None,
                 n_partitions: int | None = None) -> DataFrame:
    """Adds ``{prefix}{v}`` = value of the previous (``prev``) or next
    (``next``) row of the same key in ``order_cols`` order, and
    ``{prefix}_exists`` (false on the first / last row of a key)."""
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    prefix = prefix if prefix is not None else f"{direction}_"
    vals = F.struct(*[F.col(v) for v in value_cols], F.lit(True).alias("_exists"))
    order = F.struct(*[F.col(c) for c in order_cols])
    ranged = _freeze(_by_range(df, [*key, *order_cols], n_partitions)
                     .withColumn("_pid", F.spark_partition_id()))

    w = Window.partitionBy(*key, "_pid").orderBy(*order_cols)
    if direction == "prev":
        local = F.lag(vals).over(w)
        edge = F.row_number().over(w) == 1
    else:
        local = F.lead(vals).over(w)
        edge = F.lead(F.lit(True)).over(w).isNull()
    sliced = ranged.withColumns({"_local": local, "_edge": edge})

    ends = ranged.groupBy(*key, "_pid").agg(
        F.min_by(vals, order).alias("_first"), F.max_by(vals, order).alias("_last"))
    wb = Window.partitionBy(*key).orderBy("_pid")
    neighbour = (F.lag("_last").over(wb) if direction == "prev" else F.lead("_first").over(wb))
    # null-safe: a null key is a key like any other, cut into slices too
    ends = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_pid").alias("_kp"),
                       neighbour.alias("_nb"))
    same = F.col("_pid") == F.col("_kp")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    j = sliced.join(ends, same, "left").drop("_kp", *[f"_k{i}" for i in range(len(key))])
    picked = F.when(F.col("_edge"), F.col("_nb")).otherwise(F.col("_local"))
    out = j.withColumn("_picked", picked)
    out = out.withColumns({f"{prefix}{v}": F.col("_picked")[v] for v in value_cols})
    out = out.withColumn(f"{prefix}_exists", F.coalesce(F.col("_picked")["_exists"], F.lit(False)))
    return out.drop("_pid", "_local", "_edge", "_nb", "_picked")
