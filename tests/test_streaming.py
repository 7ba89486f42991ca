"""Streaming forms: incremental landing, replay, redelivery dedup, upsert, daily windows."""

import json
import os


from civicspark.plans import jobs
from civicspark.streaming import feeds
from civicspark.session import shared_path


def write_page(d, name, records):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump(records, f)


def rec(i, day, status="Open", borough="BRONX"):
    return {"unique_key": str(i), "created_date": f"2024-05-{day:02d}T10:00:00.000",
            "status": status, "borough": borough}


def test_available_now_increments_equal_one_batch_and_replay_adds_nothing(spark, tmp_dir):
    land, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    write_page(land, "p0.json", [rec(i, 1) for i in range(100)])
    feeds.land_requests(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"),
                        table, ckpt).awaitTermination()
    write_page(land, "p1.json", [rec(i, 2) for i in range(100, 250)])
    feeds.land_requests(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"),
                        table, ckpt).awaitTermination()
    feeds.land_requests(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"),
                        table, ckpt).awaitTermination()                  # replay: nothing new
    got = spark.read.parquet(table)
    assert got.count() == 250 and got.select("unique_key").distinct().count() == 250
    assert got.columns[-3:] == ["_ingested_at", "_ingestion_mode", "_source"]
    batch = jobs.request_rows(spark, land, "incremental", "2024-05-03 00:00:00", "2024-05-02 00:00:00")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_redeliveries_dropped_within_watermark(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    write_page(land, "a.json", [rec(i, 1) for i in range(60)])
    write_page(land, "b.json", [rec(i, 1) for i in range(40, 100)])      # 20 repeats
    rows = feeds.event_time(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"))
    q = (feeds.dedupe_redeliveries(rows).writeStream.format("memory").queryName("dedup_test")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_test").count() == 100


def test_streaming_upsert_keeps_newest_status(spark, tmp_dir):
    land, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    table = shared_path(spark, "test-stream-upsert")
    write_page(land, "a.json", [rec(i, 1, "Open") for i in range(50)])
    feeds.upsert_latest_requests(feeds.request_stream(spark, land, ingested_at="2024-05-01 00:00:00"),
                                 table, ckpt).awaitTermination()
    write_page(land, "b.json", [rec(i, 1, "Closed") for i in range(25, 75)])
    feeds.upsert_latest_requests(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"),
                                 table, ckpt).awaitTermination()
    got = {r.unique_key: r.status for r in spark.read.parquet(table).collect()}
    assert len(got) == 75
    assert got["10"] == "Open" and got["30"] == "Closed" and got["70"] == "Closed"
    day_dirs = [d for d in os.listdir(table.removeprefix("file:")) if d.startswith("_created_day=")]
    assert day_dirs == ["_created_day=2024-05-01"]


def test_daily_windows_wait_for_watermark(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    write_page(land, "a.json", [rec(i, 1 + i % 10, borough=" bronx ") for i in range(100)])
    rows = feeds.event_time(feeds.request_stream(spark, land, ingested_at="2024-05-02 00:00:00"))
    q = (feeds.daily_volume_stream(rows).writeStream.format("memory").queryName("daily_test")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    days = {r.day_start.day: r.n for r in spark.table("daily_test").collect()}
    # watermark = max time (May 10) - 3 days: windows ending by May 7 are final
    assert set(days) == set(range(1, 7)) and all(n == 10 for n in days.values())
    assert {r.borough for r in spark.table("daily_test").collect()} == {"BRONX"}


def test_late_rows_do_not_reopen_final_days(spark, tmp_dir):
    land, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    write_page(land, "a.json", [rec(i, 1 + i % 10) for i in range(100)])     # May 1-10

    def run(name):
        rows = feeds.event_time(feeds.request_stream(spark, land, ingested_at="2024-05-11 00:00:00"))
        q = (feeds.daily_volume_stream(rows).writeStream.format("parquet")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()

    run("first")
    write_page(land, "b.json", [rec(1000 + i, 2) for i in range(5)] +         # May 2: behind watermark
               [rec(2000 + i, 9) for i in range(5)])                          # May 9: still open
    run("second")
    days = {}
    for r in spark.read.parquet(f"{tmp_dir}/out").collect():
        days[r.day_start.day] = days.get(r.day_start.day, 0) + r.n
    assert days[2] == 10                   # late rows for a final day are dropped
    assert set(days) == set(range(1, 7))   # watermark (May 10 - 3 days) still holds May 7-10 open


def test_redelivery_within_lookback_dropped_across_runs(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    write_page(land, "a.json", [rec(i, 5) for i in range(30)])
    write_page(land, "b.json", [rec(i, 6) for i in range(20, 40)])   # 10 re-deliveries, a day later
    rows = feeds.event_time(feeds.request_stream(spark, land, ingested_at="2024-05-07 00:00:00",
                                                 max_files_per_trigger=1))
    q = (feeds.dedupe_redeliveries(rows).writeStream.format("memory").queryName("redeliver_test")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("redeliver_test").select("unique_key").distinct().count() == 40
    assert spark.table("redeliver_test").count() == 40
