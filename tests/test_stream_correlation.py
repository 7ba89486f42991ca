"""Stream-stream correlation against the batch model; the survey stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from civicspark.operators import analytics, requests
from civicspark.session import shared_path
from civicspark.sinks import versions
from civicspark.streaming import correlation, feeds
from tests.test_feeds import DOC, SURVEY


def put(folder, name, payload):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))


def test_final_days_equal_the_batch_model(spark, tmp_dir):
    doc = json.loads(DOC) if isinstance(DOC, str) else DOC
    start = 1_714_521_600                                                     # 2024-05-01 00:00 UTC
    boroughs = ["Bronx", "Queens"]
    for day in [*range(1, 9), 28, 29]:
        put(f"{tmp_dir}/rq", f"d{day:02d}.json",
            [{"unique_key": f"{day}-{b}-{i}", "created_date": f"2024-05-{day:02d}T{i % 24:02d}:10:00.000", "borough": b.upper()}
             for b in boroughs for i in range(3 + (day * 7 + len(b)) % 11)])
        for b in boroughs:
            if day == 4 and b == "Queens":
                continue                                                      # a day without an observation
            for hour in (5, 15):
                d = json.loads(json.dumps(doc))
                d["dt"], d["main"]["temp"] = start + (day - 1) * 86400 + hour * 3600, 10.0 + (day * 5 + hour) % 7
                put(f"{tmp_dir}/wx/borough={b}", f"d{day:02d}-{hour}.json", d)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def run():
        rq = feeds.request_stream(spark, f"{tmp_dir}/rq", ingested_at="2024-06-01 00:00:00", max_files_per_trigger=4)
        wx = correlation.weather_stream(spark, f"{tmp_dir}/wx", "2024-06-01 00:00:00", max_files_per_trigger=12)
        (correlation.daily_correlation_rows(rq, wx).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start().awaitTermination())

    run()
    put(f"{tmp_dir}/rq", "late.json", [{"unique_key": "late", "created_date": "2024-05-02T01:00:00.000", "borough": "BRONX"}])
    run()                                                                     # behind the watermark: changes nothing
    got = spark.read.parquet(out).filter("day_start < '2024-05-20'")
    assert got.count() == 16 and got.filter("mean_temp is null").count() == 1
    rows = feeds.request_stream(spark, f"{tmp_dir}/rq", ingested_at="2024-06-01 00:00:00")
    assert rows.isStreaming
    from civicspark.plans import jobs
    raw = jobs.request_rows(spark, f"{tmp_dir}/rq", "historical", "2024-06-01 00:00:00", "2024-06-01 00:00:00").filter(
        "unique_key <> 'late' and created_date < '2024-05-20'")
    wx = jobs.weather_rows(spark, f"{tmp_dir}/wx", "2024-06-01 00:00:00")
    none = spark.createDataFrame([], "borough string")
    want = analytics.weather_vs_requests(requests.typed_requests(raw), wx, none)
    same = ["borough", "n_days", "requests", "corr_temp"]
    assert sorted(map(tuple, correlation.correlation(got).select(*same).collect())) == sorted(map(tuple, want.select(*same).collect()))


def test_survey_stream_merges_each_document_once(spark, tmp_dir):
    table = shared_path(spark, "test-survey-stream")
    doc = json.loads(SURVEY) if isinstance(SURVEY, str) else SURVEY

    def run(checkpoint="c"):
        correlation.survey_upserts(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/{checkpoint}", "2024-06-01 00:00:00").awaitTermination()
        return {(r.borough, r.total_population) for r in versions.read(spark, table).collect()}

    put(f"{tmp_dir}/in", "a.json", doc)
    first = run()
    number = versions.latest(spark, table).number
    assert run() == first and versions.latest(spark, table).number == number
    doc[1][1] = "777"
    put(f"{tmp_dir}/in", "b.json", doc)
    second = run()
    assert len(second) == len(first) and 777.0 in {p for _, p in second}
    assert run("again") == second                                             # all files again: same rows
    put(f"{tmp_dir}/in", "c.json", "[")
    with pytest.raises(Exception, match="malformed"):
        run()
    assert versions.read(spark, table).filter(F.col("borough") == "Unknown").count() == 0
