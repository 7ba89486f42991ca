"""Chunks of loads: what versions really wrote, from their manifests."""

import pytest

from civicspark.sinks import versions


def told(spark, path):
    return [tuple(r) for r in versions.chunks(spark, path).orderBy("version", "chunk_no").collect()]


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, day string, v int")


def test_a_table_without_versions_has_no_chunks(spark, tmp_path):
    assert told(spark, str(tmp_path / "none")) == []
    path = str(tmp_path / "t")
    versions.create(spark, path, rows(spark, ("a", "d", 1)).schema)
    assert told(spark, path) == []


def test_chunks_by_partition_with_running_total(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, ("b", "d2", 1), ("a", "d1", 1), ("c", "d1", 1), ("e", None, 1)).coalesce(1)
    versions.append(first, path, "day", ["k"])
    versions.append(rows(spark).coalesce(1), path, "day", ["k"])                     # nothing, no version
    versions.append(rows(spark, ("x", "d1", 1), ("y", "d1", 2)).coalesce(1), path, "day", ["k"])
    assert told(spark, path) == [
        (1, 1, None, 1, 1, "e", "e", 1, False), (1, 2, "d1", 1, 2, "a", "c", 3, False), (1, 3, "d2", 1, 1, "b", "b", 4, True),
        (2, 1, "d1", 1, 2, "x", "y", 2, True)]


def test_files_are_those_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.append(spark.range(1000).selectExpr("cast(id as string) k", "'d' day", "1 v").coalesce(1), path, "day", ["k"],
                    max_records_per_file=300)
    (only,) = told(spark, path)
    assert only == (1, 1, "d", 4, 1000, "0", "999", 1000, True)
    assert len(list((tmp_path / "t" / "data").rglob("*.parquet"))) == 4


def test_a_load_that_was_not_published_does_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.append(rows(spark, ("a", "d1", 1)).coalesce(1), path, "day", ["k"])

    def killed(*_):
        raise RuntimeError("killed before the pointer")
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", killed)
        with pytest.raises(RuntimeError):
            versions.append(rows(spark, ("b", "d1", 1)).coalesce(1), path, "day", ["k"])
    assert [r[:6] for r in told(spark, path)] == [(1, 1, "d1", 1, 1, "a")]


def test_rewritten_files_count_for_the_version_that_wrote_them(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.append(rows(spark, ("a", "d1", 1), ("b", "d2", 1)).coalesce(1), path, "day", ["k"])
    versions.upsert(rows(spark, ("a", "d1", 9)), path, ["k"], ["v"], "day")
    got = told(spark, path)
    assert [r[:3] + r[4:5] for r in got if r[0] == 1] == [(1, 1, "d1", 1), (1, 2, "d2", 1)]
    assert [r[2:] for r in got if r[0] == 2] == [("d1", 1, 1, "a", "a", 1, True)]
