"""Versioned loads from real files: each file once, every payload accounted for, feed order, lengths."""

import json
import os

import pytest
from pyspark.sql import functions as F

from civicspark.operators import history
from civicspark.plans import loads
from civicspark.session import shared_path
from civicspark.sinks import versions
from civicspark.sources import arrivals
from tests.test_feeds import DOC, SURVEY, variant


def land(folder, name, payload, at=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(payload if isinstance(payload, str) else json.dumps(payload))
    if at:
        os.utime(path, (at, at))


def rec(i, day=1, **more):
    return {"unique_key": str(i), "created_date": f"2024-05-{day:02d}T10:00:00.000", **more}


NOW = {"as_of": "2024-05-03 12:00:00", "ingested_at": "2024-05-03 12:00:00"}


@pytest.fixture
def table(spark):
    return shared_path(spark, "test-load")


def test_each_file_is_loaded_once_and_a_replaced_one_again(spark, tmp_dir, table):
    d = f"{tmp_dir}/in"
    land(f"{d}/load_date=2024-05-01", "a.json", [rec(1), rec(2)])
    land(f"{d}/load_date=2024-05-02", "b.json", [rec(3)])
    first = loads.load_requests(spark, d, table, **NOW)
    assert (first.rows, first.files, first.rejected) == (3, 2, 0)
    assert loads.load_requests(spark, d, table, **NOW).version == first.version          # nothing new
    land(f"{d}/load_date=2024-05-03", "c.json", [rec(4)])
    land(f"{d}/load_date=2024-05-01", "a.json", [rec(1), rec(2), rec(5)])                # replaced: other size
    assert loads.load_requests(spark, d, table, since="2024-05-03", **NOW).rows == 1
    assert loads.load_requests(spark, d, table, **NOW).rows == 3
    got = versions.read(spark, table)
    assert sorted(r.unique_key for r in got.collect()) == ["1", "1", "2", "2", "3", "4", "5"]
    assert loads.load_requests(spark, d, table, again=True, **NOW).rows == 5
    assert [r["rows"] for r in versions.history(spark, table).orderBy("version").collect()] == [0, 3, 1, 3, 5]
    plan = arrivals._listing(spark, d, "2024-05-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan


def test_a_load_that_dies_consumes_nothing(spark, tmp_dir, table, monkeypatch):
    land(f"{tmp_dir}/in", "a.json", [rec(1)])
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            loads.load_requests(spark, f"{tmp_dir}/in", table, **NOW)
    assert loads.load_requests(spark, f"{tmp_dir}/in", table, **NOW).rows == 1
    assert versions.read(spark, table).count() == 1


def test_request_rejects_by_reason(spark, tmp_dir, table):
    d = f"{tmp_dir}/in"
    land(d, "empty.json", "")
    land(d, "blank.json", " \n\t ")
    land(d, "cut.json", '[{"unique_key":"1"')
    land(d, "object.json", '"text"')
    land(d, "mixed + odd%20name.json", [rec(1), 7, None, rec(2), "x", [1]])
    land(d, "end.json", "[]")
    land(d, "long.json", [rec(3), {**rec("4" * 60)}, {**rec(5), "city": "c" * 101}])
    land(d, "good.json", [rec(6, agency="A"), rec(7)])
    done = loads.load_requests(spark, d, table, **NOW)
    assert done.files == 8
    assert sorted(r.unique_key for r in versions.read(spark, table).collect()) == ["1", "2", "3", "6", "7"]
    dead = loads.read_rejects(spark, table)
    got = sorted((os.path.basename(r.path).split(".")[0], r.position, r.reason) for r in dead.collect())
    assert got == [("blank", 0, "empty"), ("cut", 0, "malformed"), ("empty", 0, "empty"), ("long", 1, "over length: unique_key"),
                   ("long", 2, "over length: city"), ("mixed + odd%20name", 1, "not an object"),
                   ("mixed + odd%20name", 2, "not an object"), ("mixed + odd%20name", 4, "not an object"),
                   ("mixed + odd%20name", 5, "not an object"), ("object", 0, "malformed")]
    assert done.rejected == 10 and done.reasons == {"empty": 2, "malformed": 2, "not an object": 4, "over length": 2}
    assert {r.payload for r in dead.filter("reason = 'not an object'").collect()} == {"7", "null", "x", "[1]"}


def test_weather_rejects_and_missing_boroughs(spark, tmp_dir, table):
    d = f"{tmp_dir}/wx"
    land(f"{d}/borough=Manhattan", "ok.json", DOC)
    land(f"{d}/borough=Queens", "no_temp.json", variant(main__temp=...))
    bad = variant()
    bad = json.loads(bad) if isinstance(bad, str) else bad
    bad["main"]["temp"] = "abc"
    land(f"{d}/borough=Bronx", "text.json", json.dumps(bad))
    land(f"{d}/borough=Bronx", "list.json", "[1]")
    land(f"{d}/borough=Brooklyn", "empty.json", "")
    long = json.loads(json.dumps(bad))
    long["main"]["temp"], long["name"] = "21.5", "n" * 101
    land(f"{d}/borough=Bronx", "long.json", json.dumps(long))
    with pytest.raises(ValueError, match="rejected"):
        loads.load_weather(spark, d, table, "2024-05-02 00:00:00")
    assert versions.read(spark, table).count() == 0
    done = loads.load_weather(spark, d, table, "2024-05-02 00:00:00", on_error="quarantine")
    assert (done.rows, done.rejected) == (1, 5)
    assert set(done.missing_boroughs) == {"Brooklyn", "Queens", "Bronx", "Staten Island"}
    got = {os.path.basename(r.path): r.reason for r in loads.read_rejects(spark, table).collect()}
    assert got == {"no_temp.json": "missing: main.temp", "text.json": "not a number: main.temp", "list.json": "not an object",
                   "empty.json": "empty", "long.json": "over length: city_name"}
    land(f"{d}/borough=Queens", "ok.json", DOC)
    with pytest.raises(ValueError, match="no observation"):
        loads.load_weather(spark, d, table, "2024-05-03 00:00:00", require_all=True)
    assert loads.load_weather(spark, d, table, "2024-05-03 00:00:00").rows == 1          # the good one, once
    assert versions.read(spark, table).count() == 2


def test_survey_load_filters_counties_and_merges(spark, tmp_dir, table):
    land(f"{tmp_dir}/census", "acs.json", SURVEY)
    doc = json.loads(SURVEY) if isinstance(SURVEY, str) else SURVEY
    wanted = [r for r in doc[1:] if str(r[-1]) in ("061", "005", "047", "081", "085")]
    assert len(wanted) < len(doc) - 1
    one = loads.load_survey(spark, f"{tmp_dir}/census", table, "2024-05-01 00:00:00")
    assert one.rows == len(wanted)
    doc[1][1] = "4321"
    land(f"{tmp_dir}/census", "later.json", doc)
    land(f"{tmp_dir}/census", "none.json", "[]")
    with pytest.raises(ValueError):
        loads.load_survey(spark, f"{tmp_dir}/census", table, "2024-06-01 00:00:00")
    two = loads.load_survey(spark, f"{tmp_dir}/census", table, "2024-06-01 00:00:00", on_error="quarantine")
    assert two.reasons == {"no header": 1} and two.rows == len(wanted)
    rows = versions.read(spark, table).collect()
    assert len(rows) == len(wanted) and any(r.total_population == 4321.0 for r in rows)
    assert {r._ingested_at.month for r in rows} == {6}


def test_the_feed_order_decides_between_states_of_one_load(spark, tmp_dir, table):
    d = f"{tmp_dir}/in"
    land(d, "p1.json", [rec(1, status="Open"), rec(1, status="Closed", closed_date="2024-05-02"), rec(2, status="Closed"),
                        rec(3, status="Closed", closed_date="2024-05-02")], at=1_000)
    land(d, "p0.json", [rec(2, status="Open"), rec(3, status="Open")], at=2_000)
    loads.load_requests(spark, d, table, **NOW)
    latest = history.latest_request_rows(versions.read(spark, table))
    assert {r.unique_key: r.status for r in latest.collect()} == {"1": "Closed", "2": "Open", "3": "Open"}
    assert latest.filter(F.col("_created_day").isNull()).count() == 0


def test_empty_landing_and_unknown_mode(spark, tmp_dir, table):
    os.makedirs(f"{tmp_dir}/in")
    assert loads.load_requests(spark, f"{tmp_dir}/in", table, **NOW).rows == 0
    assert versions.read(spark, table).count() == 0 and versions.latest(spark, table).number == 1
    with pytest.raises(ValueError):
        loads.load_requests(spark, f"{tmp_dir}/in", table, "monthly")


def test_folders_of_new_files_are_read_as_folders(spark, tmp_dir, table, monkeypatch):
    d, day = f"{tmp_dir}/in", f"{tmp_dir}/in/load_date=2024-05-01"
    for i in range(3):
        land(day, f"a +%41 {i}.json", [rec(i)])
    land(day, "none.json", "")
    land(f"{d}/load_date=2024-05-02", "b.json", [rec(8)])
    roots = lambda: arrivals._roots(spark, d, *([r["path"] for r in arrivals.arrivals(spark, d, table).collect() if bool(r["size"]) == full]
                                                for full in (True, False)))
    assert [r.rpartition("/")[2] for r in roots()] == ["load_date=2024-05-01", "load_date=2024-05-02"]
    assert loads.load_requests(spark, d, table, **NOW).rows == 4
    land(day, "c.json", [rec(9)])                                     # beside files that were consumed
    land(f"{d}/load_date=2024-05-03", "d.json", [rec(10)])
    assert [r.rpartition("/")[2] for r in roots()] == ["load_date=2024-05-03", "c.json"]
    real = arrivals._roots

    def late(*a):
        found = real(*a)
        land(f"{d}/load_date=2024-05-03", "late.json", [rec(11)])     # after the folder was compared
        return found
    with monkeypatch.context() as m:
        m.setattr(arrivals, "_roots", late)
        assert loads.load_requests(spark, d, table, **NOW).rows == 2
    assert loads.load_requests(spark, d, table, **NOW).rows == 1
    got = versions.read(spark, table)
    assert sorted(int(r.unique_key) for r in got.collect()) == [0, 1, 2, 8, 9, 10, 11]


def test_a_folder_with_folders_inside_gives_its_files(spark, tmp_dir, table):
    d = f"{tmp_dir}/in"
    land(f"{d}/load_date=2024-05-01/part=1", "a.json", [rec(1)])
    land(f"{d}/load_date=2024-05-01/part=2", "b.json", [rec(2)])
    names = [r["path"] for r in arrivals.arrivals(spark, d, table).collect()]
    assert sorted(arrivals._roots(spark, d, names[:1], [])) == [names[0].rpartition("/")[0]]
    assert arrivals.payloads(spark, d, arrivals.arrivals(spark, d, table)).count() == 2
