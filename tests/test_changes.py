"""Merge on read for the request stream, incremental dimension, stored page order."""

import json
import os
import random

import pytest

from civicspark.operators import history, keyset
from civicspark.session import shared_path
from civicspark.sinks import versions
from civicspark.streaming import changes, feeds


def rec(i, day, status="Open", **more):
    return {"unique_key": i, "created_date": f"2024-05-{day:02d}T10:00:00.000", "status": status, **more}


def write_page(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(records, f)


@pytest.fixture
def table(spark):
    return shared_path(spark, "test-changes")


def stream(spark, tmp_dir, table, day, checkpoint="ckpt", **kw):
    rows = feeds.request_stream(spark, f"{tmp_dir}/in", ingested_at=f"2024-06-{day:02d} 00:00:00")
    changes.log_latest_requests(rows, table, f"{tmp_dir}/{checkpoint}", **kw).awaitTermination()


def state(spark, table):
    rows = changes.read_latest(spark, table).collect()
    assert len(rows) == len({r[changes.KEY] for r in rows})
    return sorted((r.unique_key or "", r.status, str(r[changes.DAY])) for r in rows)


@pytest.mark.parametrize("compact_every", [0, 1, 2])
def test_stream_state_with_moves_keyless_rows_and_replays(spark, tmp_dir, table, compact_every):
    kw = {"compact_every": compact_every}
    write_page(f"{tmp_dir}/in", "a.json", [rec("A", 1), rec("B", 1), rec("", 1, "x"), rec("", 1, "x"), rec("", 1, "y"), rec(None, 2, "z")])
    stream(spark, tmp_dir, table, 1, **kw)
    want = [("", "x", "2024-05-01"), ("", "y", "2024-05-01"), ("", "z", "2024-05-02"), ("A", "Open", "2024-05-01"),
            ("B", "Open", "2024-05-01")]
    assert state(spark, table) == want
    # a changed day, a closed request, the same keyless row again
    write_page(f"{tmp_dir}/in", "b.json", [rec("A", 3, "Closed"), rec("", 1, "x"), rec("C", 4)])
    stream(spark, tmp_dir, table, 2, **kw)
    want = sorted([*[w for w in want if w[0] != "A"], ("A", "Closed", "2024-05-03"), ("C", "Open", "2024-05-04")])
    assert state(spark, table) == want
    # reopened by a later load
    write_page(f"{tmp_dir}/in", "c.json", [rec("A", 3, "Open")])
    stream(spark, tmp_dir, table, 3, **kw)
    want = sorted([*[w for w in want if w[0] != "A"], ("A", "Open", "2024-05-03")])
    assert state(spark, table) == want
    # everything once more under another checkpoint, as an older load
    stream(spark, tmp_dir, table, 1, "other", **kw)
    assert state(spark, table) == want
    if changes.read_latest(spark, table).count():
        changes.compact(spark, table)
    assert state(spark, table) == want
    assert versions.read(spark, table).count() == len(want)
    assert versions.files(spark, table, kind=changes.CHANGES).count() == 0


def test_a_replayed_batch_is_published_once(spark, tmp_dir, table):
    batch = spark.createDataFrame([("A", "2024-05-01T00:00:00", "Open", "", 1), ("", "2024-05-01T00:00:00", "Open", "", 1)],
                                  "unique_key string, created_date string, status string, closed_date string, _ingested_at int")
    first = changes.append_batch(batch, table, "s", 0)
    assert changes.append_batch(batch, table, "s", 0).number == first.number
    changes.compact(spark, table)
    assert changes.append_batch(batch, table, "s", 0).number == first.number + 1      # carried over the compaction
    assert changes.append_batch(batch, table, "s", 1).number == first.number + 2
    assert changes.read_latest(spark, table).count() == 2


def test_compaction_rewrites_only_files_with_changes(spark, table):
    columns = "unique_key string, created_date string, status string, closed_date string, _ingested_at int"
    rows = [(f"k{i}", f"2024-05-{1 + i % 9:02d}T00:00:00", "Open", "", 1) for i in range(90)]
    changes.append_batch(spark.createDataFrame(rows, columns), table, "s", 0)
    changes.compact(spark, table)
    before = {r.file for r in versions.files(spark, table).collect()}
    changes.append_batch(spark.createDataFrame([("k0", "2024-05-09T00:00:00", "Closed", "x", 2)], columns), table, "s", 1)
    changes.compact(spark, table)
    gone = before - {r.file for r in versions.files(spark, table).collect()}
    assert gone and all("_created_day=2024-05-01" in f for f in gone)
    assert versions.read(spark, table).filter("unique_key = 'k0'").select("status").collect()[0][0] == "Closed"
    assert versions.read(spark, table).count() == 90


# --- incremental dimension ----------------------------------------------------------------

DIM = "k string, a int, b string, valid_from int, valid_to int, is_current boolean, observed array<int>"


def test_any_order_of_loads_equals_the_full_build(spark):
    rng = random.Random(4)
    rows = {(k, y): (k, y, rng.choice([1, 2, None]), rng.choice(["p", None])) for k in ("A", "B", "C") for y in range(2015, 2024)
            if rng.random() < 0.8}
    late = {(k, 2018): (k, 2018, 7, "q") for k in ("A", "B")}                  # comes again with other values
    final = {**rows, **late}
    full = history.scd2(spark.createDataFrame(list(final.values()), "k string, y int, a int, b string"), ["k"], ["y"],
                        ["a", "b"], "y", skew_safe=False)
    want = sorted(map(tuple, full.collect()), key=str)
    years = sorted({y for _, y in rows})
    for order in [years, years[::-1], *[rng.sample(years, len(years)) for _ in range(2)]]:
        path = shared_path(spark, "test-dim")
        schema = versions.struct(spark, DIM)
        versions.create(spark, path, schema)
        for part in [[y for y in order[:5]], order[5:], [2018]]:
            source = late.values() if part == [2018] else [rows[k, y] for k, y in rows if y in part]
            new = spark.createDataFrame(list(source), "k string, y int, a int, b string")
            merged = history.scd2_merge(versions.read(spark, path), new, ["k"], "y", ["a", "b"])
            versions.replace_keys(merged.select(*schema.names), path, ["k"])
        got = versions.read(spark, path).drop("observed")
        assert sorted(map(tuple, got.collect()), key=str) == want
    none = spark.createDataFrame([], "k string, y int, a int, b string")
    assert history.scd2_merge(versions.read(spark, path), none, ["k"], "y", ["a", "b"]).count() == 0


# --- stored page order --------------------------------------------------------------------

def test_pages_read_the_files_that_hold_them(spark):
    rows = [(i, (i * 7919) % 101, f"t{i}") for i in range(2_000)]
    df = spark.createDataFrame(rows, "id int, t int, note string").repartition(7)
    path, cols = shared_path(spark, "test-pages"), ["t", "id"]
    keyset.store(df, path, cols, rows_per_file=150, partitions=5)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    read = []
    for n in range(21):
        p = keyset.page(spark, path, df.schema, cols, n, 100)
        assert [r.id for r in p.collect()] == want[n * 100:(n + 1) * 100]
        read.append(len(p.inputFiles()))
    assert max(read) <= 3 and max(read[10:]) <= max(read[:10])      # deep pages read no more than the first ones
    got = []
    p = keyset.page(spark, path, df.schema, cols, 0, 130).collect()
    while p:
        got += [r.id for r in p]
        q = keyset.page_after(spark, path, df.schema, cols, (p[-1].t, p[-1].id), 130)
        assert len(q.inputFiles()) <= 3
        p = q.collect()
    assert got == want
    empty = shared_path(spark, "test-pages")
    keyset.store(df.limit(0), empty, cols)
    assert keyset.page(spark, empty, df.schema, cols, 0).count() == 0
    assert keyset.page_after(spark, empty, df.schema, cols, (1, 1)).count() == 0
