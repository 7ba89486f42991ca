"""Paging, global index, skew-safe lag/lead, latest row, SCD2."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicspark.operators import history, ordered, paging
from tests.conftest import SF_MID

EVENTS = f"{SF_MID}/events.parquet"


def test_global_index_matches_row_number(spark):
    e = spark.read.parquet(EVENTS).select("event_id", "ts")
    got = ordered.global_index(e, ["ts", "event_id"], "idx", n_partitions=7)
    ref = e.withColumn("idx", F.row_number().over(Window.orderBy("ts", "event_id")) - 1)
    assert got.count() == e.count()
    assert got.join(ref, ["event_id", "idx"]).count() == e.count()


def test_pages_partition_the_input_and_deep_path_agrees(spark, monkeypatch):
    e = spark.read.parquet(EVENTS).select("event_id", "ts")
    shallow = [paging.page_slice(e, ["ts", "event_id"], p, 3000).collect() for p in range(4)]
    monkeypatch.setattr(paging, "TOP_K_ROWS", 0)        # force the distributed path
    deep = [paging.page_slice(e, ["ts", "event_id"], p, 3000).collect() for p in range(4)]
    assert [sorted(r.event_id for r in p) for p in shallow] == \
        [sorted(r.event_id for r in p) for p in deep]
    ids = [r.event_id for p in shallow for r in p]
    assert len(ids) == len(set(ids)) == e.count()
    assert [len(p) for p in shallow] == [3000, 3000, 3000, 1000]


def test_page_report_end_of_feed(spark):
    e = spark.read.parquet(EVENTS).select("event_id", "ts")       # 10,000 rows
    short = {r.page_no: r for r in paging.page_report(e, ["ts", "event_id"], "event_id", 3000).collect()}
    assert [short[p].n_rows for p in sorted(short)] == [3000, 3000, 3000, 1000]
    assert short[3].is_last and not short[3].extra_fetch and not short[2].is_last
    exact = paging.page_report(e, ["ts", "event_id"], "event_id", 2500).collect()
    last = max(exact, key=lambda r: r.page_no)
    assert last.is_last and last.extra_fetch        # exact multiple costs an empty fetch


def test_batch_report_running_total(spark):
    e = spark.read.parquet(EVENTS).select("event_id", "ts")
    b = sorted(paging.batch_report(e, ["ts", "event_id"], "event_id", 3000).collect(),
               key=lambda r: r.batch_no)
    assert [(r.batch_no, r.n_rows, r.running_total) for r in b] == \
        [(1, 3000, 3000), (2, 3000, 6000), (3, 3000, 9000), (4, 1000, 10000)]


def skewed(spark):
    """One key holds ~70% of the rows."""
    return spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 13 + 1).alias("k"),
        (F.col("id") * 7919 % 20000).alias("t"),
        (F.col("id") % 3).alias("v"))


def test_shift_within_splits_hot_key_and_matches_window(spark):
    df = skewed(spark)
    ranged = df.repartitionByRange(8, "k", "t").select("k", F.spark_partition_id().alias("p"))
    assert ranged.filter("k = 0").select("p").distinct().count() > 1   # hot key is split
    got = ordered.shift_within(df, ["k"], ["t"], ["v"], "prev", n_partitions=8)
    got = ordered.shift_within(got, ["k"], ["t"], ["v"], "next", n_partitions=8)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"),
                    (F.row_number().over(w) > 1).alias("prev__exists"))
    cols = ["k", "t", "prev_v", "next_v", "prev__exists"]
    assert got.select(*cols).exceptAll(ref.select(*cols)).count() == 0
    assert got.count() == df.count()


def test_latest_by_key_one_row_per_key(spark):
    e = spark.read.parquet(EVENTS).select("user_id", "event_id", "ts", "event_type")
    got = history.latest_by_key(e, ["user_id"], ["ts", "event_id"])
    assert got.count() == e.select("user_id").distinct().count()
    ref = e.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert got.join(ref, ["user_id", "ts"]).count() == got.count()


def test_scd2_intervals_cover_and_do_not_overlap(spark):
    e = spark.read.parquet(EVENTS).select("user_id", "ts", "event_id", "event_type")
    v = history.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"], "ts").collect()
    by_user = {}
    for r in v:
        by_user.setdefault(r.user_id, []).append(r)
    firsts = {r.user_id: r.ts for r in e.groupBy("user_id").agg(F.min("ts").alias("ts")).collect()}
    for u, rows in by_user.items():
        rows.sort(key=lambda r: r.valid_from)
        assert rows[0].valid_from == firsts[u]
        assert sum(r.is_current for r in rows) == 1 and rows[-1].is_current
        for a, b in zip(rows, rows[1:]):
            assert a.valid_to == b.valid_from          # contiguous, no overlap
            assert a.event_type != b.event_type        # unchanged rows collapsed


def test_scd2_window_path_equals_skew_safe_path(spark):
    e = spark.read.parquet(EVENTS).select("user_id", "ts", "event_id", "event_type")
    a = history.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"], "ts")
    b = history.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"], "ts", skew_safe=False)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
