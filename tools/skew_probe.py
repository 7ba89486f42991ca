"""Measure how a hot key spreads over tasks: per-key lag over ``events`` with
one user holding a third of the rows, as a plain window and with
``shift_within``.  Reads per-task shuffle records from Spark's event log
(written to a fresh scratch folder) and prints the largest task of each run.

usage: python tools/skew_probe.py [sf_dir] [partitions]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from civicspark.operators.history import latest_by_key  # noqa: E402
from civicspark.operators.ordered import shift_within  # noqa: E402
from civicspark.session import get_session  # noqa: E402


def read_lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        return data.decode().splitlines()
    return open(path).read().splitlines()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = get_session("local[8]", parts, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.enabled": "false"})    # keep raw task sizes visible
    e = spark.read.parquet(f"{sf}/events.parquet").select(
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "ts", "event_id", "event_type")
    sc = spark.sparkContext
    sc.setJobGroup("plain", "plain window")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e.withColumn("prev", F.lag("event_type").over(w)).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("skew_safe", "shift_within")
    shift_within(e, ["user_id"], ["ts", "event_id"], ["event_type"], "prev") \
        .write.format("noop").mode("overwrite").save()
    sc.setJobGroup("latest_max_by", "latest_by_key")
    latest_by_key(e, ["user_id"], ["ts", "event_id"]).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, task_reads = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        for line in read_lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if n:
                    task_reads[ev["Stage ID"]].append(n)
    for g in ("plain", "skew_safe", "latest_max_by"):
        stages = {s: r for s, r in task_reads.items() if stage_group.get(s) == g}
        worst = max((max(r) for r in stages.values()), default=0)
        print(json.dumps({"run": g, "partitions": parts, "shuffle_stages": len(stages),
                          "largest_task_records": worst,
                          "per_stage_max": {s: max(r) for s, r in sorted(stages.items())}}))
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
