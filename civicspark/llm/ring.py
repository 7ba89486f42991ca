"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 32-bit ring.  A row's ring position is
a hash of its key alone; its home is the first virtual node at or after that
position.  Each shard has a capacity, and the capacities add up to the number
of rows (shard ``s`` takes one more when ``s < rows mod shards``), so at the
end every shard is exactly full: counts differ by at most one (law ``rows``).

Rows apply to their home in rounds.  A shard accepts applicants, in ring order
of their arc and by rank inside it, while it has room; what overflows continues
clockwise to the next virtual node whose shard still has room.  A shard takes
its own arcs first, so only the excess over the capacity leaves home: when a
shard is added, little moves besides the rows it takes over.

Only the number of rows per arc (``shards x vnodes`` numbers, a bound set by
parameters) reaches the driver.  It splits each arc into runs of consecutive
ranks; a row's rank in its arc then decides shard and slot.  Ranks are counted
inside slices of the ring, whose number follows the row count, so no window
holds a whole arc.

Defined cases: a null key has a position of its own (hash of an empty text);
rows with equal keys share a position, are ranked by the remaining columns and
may be parted by an overflow; identical rows are interchangeable.  An empty
table gives an empty result.  Other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.store import written

RING_BITS = 32
CELL_BITS = 12              # look-up cells of the ring: 4,096 rows, whatever the data
ROWS_PER_SLICE = 50_000     # aimed size of one ranking window
INTERVALS = "arc int, from_rank long, to_rank long, shard int, slot_from long"


def ring_position(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def position_column(key: Column) -> Column:
    """``ring_position`` of the key's text as a Column."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def virtual_nodes(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order."""
    return sorted((ring_position(f"shard {s} node {v}"), s)
                  for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan_runs(ring: list[tuple[int, int]], counts: dict[int, int],
              shards: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(arc, from_rank, to_rank, shard, slot_from)`` that cover every rank of every arc."""
    room = capacities(sum(counts.values()), shards)
    applying = [(arc, 0, counts[arc], arc) for arc in sorted(counts)]     # arc, rank, rows, node
    accepted: list[tuple[int, int, int, int]] = []
    while applying:
        overflow = []
        for arc, rank, rows, node in applying:
            shard = ring[node][1]
            take = min(room[shard], rows)
            if take:
                room[shard] -= take
                accepted.append((shard, arc, rank, take))
            if rows > take:
                overflow.append((arc, rank + take, rows - take, node))
        applying = []
        for arc, rank, rows, node in overflow:
            while not room[ring[node][1]]:
                node = (node + 1) % len(ring)
            applying.append((arc, rank, rows, node))
    runs, slots = [], [0] * shards
    for shard, arc, rank, take in sorted(accepted):
        runs.append((arc, rank, rank + take, shard, slots[shard]))
        slots[shard] += take
    return runs


def _arc(spark, ring: list[tuple[int, int]], keys: DataFrame) -> DataFrame:
    """Adds ``arc``: the index of the first virtual node at or after ``position``.  The
    ring is cut into equal cells; a cell knows its nodes and how many lie before it."""
    shift = RING_BITS - CELL_BITS
    at = [p for p, _ in ring]
    cells = []
    for c in range(1 << CELL_BITS):
        lo, hi = bisect.bisect_left(at, c << shift), bisect.bisect_left(at, (c + 1) << shift)
        cells.append((c, lo, at[lo:hi]))
    table = spark.createDataFrame(cells, "cell long, before int, nodes array<long>")
    inside = F.size(F.filter("nodes", lambda p: p < F.col("position")))
    joined = keys.withColumn("cell", F.shiftright("position", shift)).join(F.broadcast(table), "cell")
    return (joined.withColumn("arc", F.pmod(F.col("before") + inside, F.lit(len(ring))).cast("int"))
            .drop("cell", "before", "nodes"))


def assign(rows: DataFrame, key: str, shards: int = 24, vnodes: int = 128,
           order_by: list[str] | None = None) -> DataFrame:
    """``rows`` plus ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``order_by`` names the columns that order rows with equal keys (default: all
    others).  ``rows`` is written once, so hand over the columns needed, not texts."""
    spark = rows.sparkSession
    ties = order_by if order_by is not None else [c for c in rows.columns if c != key]
    ring = virtual_nodes(shards, vnodes)
    keyed = written(_arc(spark, ring, rows.withColumn("position", position_column(F.col(key)))), "ring")
    counts = {r["arc"]: r["count"] for r in keyed.groupBy("arc").count().collect()}
    total = sum(counts.values())
    bits = min(RING_BITS, max(CELL_BITS, (total // ROWS_PER_SLICE).bit_length()))
    sliced = keyed.withColumn("slice", F.shiftright("position", RING_BITS - bits))
    # the arc that wraps past the end of the ring starts there, then goes on from 0
    last = ring[-1][0]
    wrapped = (F.col("position") > last).cast("int")
    per_slice = sliced.groupBy("arc", wrapped.alias("wraps"), "slice").count()
    before = Window.partitionBy("arc").orderBy(F.desc("wraps"), "slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = per_slice.select("arc", "wraps", "slice",
                               F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    in_slice = Window.partitionBy("arc", "wraps", "slice").orderBy("position", key, *ties)
    ranked = (sliced.withColumn("wraps", wrapped)
              .withColumn("in_slice", F.row_number().over(in_slice) - 1)
              .join(offsets, ["arc", "wraps", "slice"])
              .withColumn("rank", F.col("offset") + F.col("in_slice")))
    # at most shards x vnodes runs and one more for each time an arc overflows
    runs = spark.createDataFrame(plan_runs(ring, counts, shards), INTERVALS).withColumnRenamed("arc", "run_arc")
    hit = ((F.col("arc") == F.col("run_arc")) & (F.col("rank") >= F.col("from_rank"))
           & (F.col("rank") < F.col("to_rank")))
    return ranked.join(F.broadcast(runs), hit).select(
        *rows.columns, "shard", (F.col("slot_from") + F.col("rank") - F.col("from_rank")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, vnodes: int = 128) -> DataFrame:
    """Documents to shards by ``doc_id``: size, checksum, shard and slot of each row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    return assign(rows, "doc_id", shards, vnodes).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
