"""Table contracts on DataFrames: conform to a declared schema, length checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import scalars as X
from civicspark.schemas import Col


def conform(df: DataFrame, contract: list[Col], keep: list[str] | None = None) -> DataFrame:
    """Select the contract's columns in declared order and types; a column the
    frame lacks takes its declared default (or NULL).  ``keep`` columns (e.g.
    partition columns) follow unchanged."""
    have = set(df.columns)
    cols = []
    for c in contract:
        if c.name in have:
            e = F.col(c.name)
        elif c.default is not None:
            e = F.expr(c.default)
        else:
            e = F.lit(None)
        cols.append(e.cast(c.dtype).alias(c.name))
    return df.select(*cols, *(keep or []))


def length_violations(df: DataFrame, max_lengths: dict[str, int]) -> DataFrame:
    """One row per checked column: declared length, rows over it, longest
    value seen.  A single pass with one partial aggregate per column."""
    aggs = []
    for c, n in max_lengths.items():
        aggs += [F.sum(X.over_length(c, n).cast("long")).alias(f"{c}__over"),
                 F.max(F.length(c)).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_len"),
                               F.coalesce(F.col(f"{c}__over"), F.lit(0)).cast("long").alias("n_over"),
                               F.col(f"{c}__max").cast("int").alias("longest"))
                      for c, n in max_lengths.items()])
    return wide.select(F.inline(stack))


def reject_over_length(df: DataFrame, max_lengths: dict[str, int], on_error: str = "fail"):
    """``fail``: the job errors on the first over-length value (as a VARCHAR(n)
    column would reject the load).  ``quarantine``: returns (ok, rejected)."""
    bad = F.lit(False)
    for c, n in max_lengths.items():
        bad = bad | X.over_length(c, n)
    if on_error == "fail":
        return df.filter(F.when(bad, F.raise_error(F.lit("value exceeds declared length")))
                         .otherwise(F.lit(True)))
    return df.filter(~bad), df.filter(bad)
