"""Models over tables written by the feed loads."""

import copy
import json
import os

from civicspark.plans import jobs, models
from tests.test_feeds import DOC, SURVEY


def land(d, name, payload):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(json.dumps(payload))


def build_tables(spark, root):
    # requests: key 1 is re-read by a later load with a new status
    land(f"{root}/rq1", "p.json", [
        {"unique_key": "1", "created_date": "2024-05-01T14:00:00.000", "status": "Open", "borough": "MANHATTAN"},
        {"unique_key": "2", "created_date": "2024-05-01T15:00:00.000", "status": "Open", "borough": "MANHATTAN"},
        {"unique_key": "3", "created_date": "2024-05-02T15:00:00.000", "status": "Open", "borough": "BRONX"}])
    land(f"{root}/rq2", "p.json", [
        {"unique_key": "1", "created_date": "2024-05-01T14:00:00.000", "status": "Closed", "borough": "MANHATTAN"}])
    rq = f"{root}/requests_raw"
    jobs.load_requests(spark, f"{root}/rq1", rq, "historical", as_of="2024-05-03 00:00:00",
                       ingested_at="2024-05-03 00:00:00")
    jobs.load_requests(spark, f"{root}/rq2", rq, "incremental", as_of="2024-05-04 00:00:00",
                       ingested_at="2024-05-04 00:00:00")
    # weather: Manhattan on two days
    wx = f"{root}/weather_raw"
    for i, (dt_, temp) in enumerate([(1714575600, 10.0), (1714662000, 20.0)]):
        d = copy.deepcopy(DOC)
        d["dt"], d["main"]["temp"] = dt_, temp
        land(f"{root}/wx{i}/borough=Manhattan", "o.json", d)
        jobs.load_weather(spark, f"{root}/wx{i}", wx, "2024-05-03 00:00:00")
    # survey: 2021 and 2022 equal for Manhattan, 2023 changes
    cs = f"{root}/census_raw"
    changed = copy.deepcopy(SURVEY)
    changed[1][1] = "2000"
    land(f"{root}/c0", "a.json", SURVEY)
    land(f"{root}/c1", "a.json", changed)
    jobs.load_survey(spark, f"{root}/c0", cs, "2024-01-01 00:00:00", survey_year=2021)
    jobs.load_survey(spark, f"{root}/c0", cs, "2024-01-01 00:00:00", survey_year=2022)
    jobs.load_survey(spark, f"{root}/c1", cs, "2024-01-01 00:00:00", survey_year=2023)
    return rq, wx, cs


def test_models(spark, tmp_dir):
    rq, wx, cs = build_tables(spark, tmp_dir)
    names = models.register_views(spark, rq, wx, cs)
    assert "weather_request_correlation" in names
    latest = {r.unique_key: r.status for r in spark.table("requests_latest").collect()}
    assert latest == {"1": "Closed", "2": "Open", "3": "Open"}
    dim = sorted((r.borough, r.valid_from_year, r.valid_to_year, r.is_current, r.total_population)
                 for r in spark.table("census_dimension").collect())
    assert ("Manhattan", 2021, 2023, False, 1000.0) in dim
    assert ("Manhattan", 2023, None, True, 2000.0) in dim
    assert [d for d in dim if d[0] == "Unknown"] == [("Unknown", 2021, None, True, 0.0)]
    ch = {(r.borough, r.survey_year): r.total_population_change
          for r in spark.table("census_changes").collect()}
    assert ch[("Manhattan", 2023)] == 1000.0 and ch[("Manhattan", 2021)] is None
    daily = {(r.borough, str(r.local_day)): r.n_requests for r in spark.table("requests_daily").collect()}
    assert daily == {("MANHATTAN", "2024-05-01"): 2, ("BRONX", "2024-05-02"): 1}
    corr = {r.borough: r for r in spark.table("weather_request_correlation").collect()}
    assert corr["MANHATTAN"].requests == 2 and corr["MANHATTAN"].total_population == 2000.0
    # observation at 2024-05-01 15:00 UTC is 11:00 local: it shares the requests' day
    assert corr["MANHATTAN"].n_days == 1
