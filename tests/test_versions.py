"""Versioned tables: whole loads or none, conflicts, file-level upsert, keys that change partition."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.session import shared_path
from civicspark.sinks import versions

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()),
                       T.StructField("note", T.StringType()), T.StructField("day", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, path, version=None):
    return sorted((tuple(r) for r in versions.read(spark, path, SCHEMA, version).collect()), key=str)


@pytest.fixture
def path(spark):
    return shared_path(spark, "test-versions")


def test_a_load_that_dies_before_publishing_leaves_the_table_as_it_was(spark, path, monkeypatch):
    versions.append(frame(spark, [("a", 1, None, "d1")]), path, "day", ["k"])
    reader, before = versions.read(spark, path, SCHEMA), table(spark, path)

    def dies(*_):
        raise OSError("killed")
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", dies)
        with pytest.raises(OSError):
            versions.append(frame(spark, [("b", 2, None, "d1")]), path, "day", ["k"])
        with pytest.raises(OSError):
            versions.upsert(frame(spark, [("a", 9, None, "d1")]), path, ["k"], ["v"], "day")
    assert table(spark, path) == before and versions.latest(spark, path).number == 1
    assert sorted(map(tuple, reader.collect())) == before
    versions.append(frame(spark, [("c", 3, None, None)]), path, "day", ["k"])
    assert table(spark, path) == [("a", 1, None, "d1"), ("c", 3, None, None)]
    assert sorted(map(tuple, reader.collect())) == before             # an open reader keeps its version
    assert table(spark, path, versions.at_version(spark, path, 1)) == before
    assert [(r.version, r.operation, r.rows) for r in versions.history(spark, path).orderBy("version").collect()] == \
        [(1, "append", 1), (2, "append", 1)]


def test_two_loads_from_one_version_conflict(spark, path):
    base = versions.append(frame(spark, [("a", 1, None, "d1")]), path, "day", ["k"])
    versions.append(frame(spark, [("b", 2, None, "d1")]), path, "day", ["k"], base=base)
    with pytest.raises(versions.Conflict):
        versions.upsert(frame(spark, [("a", 5, None, "d1")]), path, ["k"], ["v"], "day", base=base)
    assert table(spark, path) == [("a", 1, None, "d1"), ("b", 2, None, "d1")]
    versions.upsert(frame(spark, [("a", 5, None, "d1")]), path, ["k"], ["v"], "day")
    assert table(spark, path) == [("a", 5, None, "d1"), ("b", 2, None, "d1")]


def test_empty_loads_publish_nothing_and_odd_partition_names(spark, path):
    assert versions.append(frame(spark, []), path, "day").number == 0
    assert table(spark, path) == [] and versions.history(spark, path).count() == 0
    assert versions.upsert(frame(spark, []), path, ["k"], ["v"], "day").number == 0
    rows = [("a", 1, None, "x y+z"), ("b", 2, None, "50%/é:=1"), ("c", 3, None, ""), (None, 4, None, "x y+z")]
    versions.append(frame(spark, rows), path, "day", ["k"], index=True)
    versions.upsert(frame(spark, [("a", 7, "n", "x y+z"), ("b", 8, "n", "50%/é:=1")]), path, ["k"], ["v"], "day", index=True)
    assert [(r[0], r[1]) for r in table(spark, path)] == [("a", 7), ("b", 8), ("c", 3), (None, 4)]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_upsert_rewrites_only_files_that_hold_a_key(spark, path, broadcast_rows):
    rows = [(f"k{i:04d}", i, "old", f"d{i // 100}") for i in range(1000)]
    versions.append(frame(spark, rows).repartitionByRange(5, "k").sortWithinPartitions("k"), path, "day", ["k"],
                    max_records_per_file=20)
    before = {r.file for r in versions.files(spark, path).collect()}
    source = frame(spark, [("k0205", None, "new", "d2"), ("k0290", -1, "new", "d2"), ("zz", -2, "new", "d2"),
                           ("k0999x", 5, "new", "d11"), (None, -3, "new", "d2")])
    base = versions.latest(spark, path)
    touched = versions.files_with_keys(spark, path, base, source, ["k"], SCHEMA, "day")
    assert 1 <= len(touched) <= 2 and all("/day=d2/" in f for f in touched)
    done = versions.upsert(source, path, ["k"], ["v"], "day", broadcast_rows=broadcast_rows)
    assert done.info["files_rewritten"] == len(touched)
    after = {r.file for r in versions.files(spark, path).collect()}
    assert before - after == set(touched)
    want = {r[0]: r for r in rows}
    want["k0205"], want["k0290"] = ("k0205", None, "old", "d2"), ("k0290", -1, "old", "d2")
    want.update({"zz": ("zz", -2, "new", "d2"), "k0999x": ("k0999x", 5, "new", "d11"), None: (None, -3, "new", "d2")})
    assert table(spark, path) == sorted(want.values(), key=str)


def test_keys_that_change_partition_leave_no_old_row(spark, path):
    rng = random.Random(3)
    want = {}
    for step in range(5):
        keys = rng.sample(range(60), 25)
        rows = [(f"k{k}", step, f"s{step}", rng.choice([None, "d1", "d2", "d3"])) for k in keys]
        versions.upsert(frame(spark, rows), path, ["k"], ["v", "note", "day"], "day", index=True)
        want.update({r[0]: r for r in rows})
        assert table(spark, path) == sorted(want.values(), key=str)
    # the plan of step 1 reads buckets of the index, not the table
    src = frame(spark, [("k1", 9, None, "d9")])
    parts = versions._partitions_of(spark, path, versions.latest(spark, path), src, ["k"], SCHEMA, "day", True)
    names = [f for f in parts.inputFiles() if "/index/" in f]
    assert names and len({f.split("bucket=")[1].split("/")[0] for f in names}) == 1
    assert not any("/data/" in f for f in parts.inputFiles())


def test_duplicate_source_keys_are_rejected_before_anything_is_written(spark, path):
    with pytest.raises(ValueError):
        versions.upsert(frame(spark, [("a", 1, None, "d"), ("a", 2, None, "d")]), path, ["k"], ["v"], "day")
    assert versions.latest(spark, path).number == 0


def test_partition_pruning_reaches_the_scan(spark, path):
    versions.append(frame(spark, [(f"k{i}", i, None, f"d{i % 4}") for i in range(40)]), path, "day", ["k"])
    plan = versions.read(spark, path, SCHEMA).filter(F.col("day") == "d1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
