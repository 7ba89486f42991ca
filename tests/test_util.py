"""Helpers: conditional spreading of small inputs, count-checked broadcast."""

from civicspark.operators.util import broadcast_if_small, spread
from tests.conftest import SF_MID


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_only_when_fewer_splits_than_cores(spark):
    one_file = spark.read.parquet(f"{SF_MID}/events.parquet")       # a single row group
    spread_out = spread(one_file, ["event_id"])
    assert spread_out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(many, ["id"]) is many                                # no shuffle added


def test_broadcast_only_under_the_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    probe = spark.range(100000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # only hints may broadcast
    try:
        assert "BroadcastHashJoin" in plan(probe.join(broadcast_if_small(small, 100), "k"))
        assert "BroadcastHashJoin" not in plan(probe.join(broadcast_if_small(big, 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
