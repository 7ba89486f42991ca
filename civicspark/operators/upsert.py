"""Keyed upsert (MERGE) as a DataFrame plan.

matched       -> ``update_cols`` from the source (NULLs copied), other columns kept
not matched   -> source row inserted
target only   -> kept (no delete clause)
Presence flags, not ``coalesce``, choose the side, so a NULL in the source
overwrites a stored value.  Keys compare with ``=``: NULL keys never match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """Reject a source with repeated keys before it can hit a target row twice
    (a partial aggregate; only a 1-row probe reaches the driver)."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    dup = source.filter(known).groupBy(*keys).count().filter("count > 1").limit(1)
    if not dup.isEmpty():
        raise ValueError(f"duplicate source keys on {keys}")


# Sources up to this many rows take the broadcast path (checked with a bounded
# count); larger ones the full outer join.
BROADCAST_SOURCE_ROWS = 20_000


def merge(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
          check_unique: bool = True, broadcast_rows: int = BROADCAST_SOURCE_ROWS,
          source_rows: int | None = None) -> DataFrame:
    """Merged table.  A small source (at most ``broadcast_rows``; ``source_rows``
    when known, else counted with a ``limit``) is broadcast and the target is
    never shuffled; otherwise one full outer join shuffles both sides on the key."""
    if check_unique:
        assert_unique_keys(source, keys)
    if source_rows is None and broadcast_rows:
        source_rows = source.limit(broadcast_rows + 1).count()
    if broadcast_rows and source_rows <= broadcast_rows:
        return _merge_small_source(target, source, keys, update_cols)
    return _merge_full_outer(target, source, keys, update_cols)


def _sides(target: DataFrame, source: DataFrame):
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_s"))
    return cols, t, s


def _pick(cols, update_cols, t_here, s_here):
    out = []
    for c in cols:
        if c in update_cols:
            e = F.when(s_here, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        else:
            e = F.when(t_here, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}"))
        out.append(e.alias(c))
    return out


def _merge_full_outer(target, source, keys, update_cols) -> DataFrame:
    cols, t, s = _sides(target, source)
    j = t.join(s, [t[f"t_{k}"] == s[f"s_{k}"] for k in keys], "full_outer")
    return j.select(*_pick(cols, update_cols, F.col("_t").isNotNull(), F.col("_s").isNotNull()))


def _merge_small_source(target, source, keys, update_cols) -> DataFrame:
    """Target rows stream through a broadcast of the source (updates in place);
    source rows whose key no target row has are appended.  Those keys come from
    a key-columns-only read of the target, semi-joined to the (broadcast) source
    keys, so that result is bounded by the source size too."""
    cols, t, s = _sides(target, source)
    updated = t.join(F.broadcast(s), [t[f"t_{k}"] == s[f"s_{k}"] for k in keys], "left") \
        .select(*_pick(cols, update_cols, F.lit(True), F.col("_s").isNotNull()))
    src_keys = source.select(*keys)
    hit = target.select(*keys).join(F.broadcast(src_keys), keys, "left_semi")
    inserts = source.join(F.broadcast(hit), keys, "left_anti").select(*cols)
    return updated.unionByName(inserts)
