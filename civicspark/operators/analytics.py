"""Models on the landed tables: volumes, year-over-year change, density,
and the borough-by-day correlation of weather with request volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.functions import scalars as X


def daily_volume(df: DataFrame, ts_col: str, by: list[str], day_col: str = "day",
                 count_col: str = "n") -> DataFrame:
    """Rows per group and calendar day (map-side partial count, then one
    shuffle of at most groups x days rows)."""
    return (df.groupBy(*by, F.to_date(F.col(ts_col)).alias(day_col))
            .agg(F.count(F.lit(1)).alias(count_col)))


def change_vs_previous(agg: DataFrame, key: list[str], period: str, measure: str,
                       prev_col: str = "prev", change_col: str = "change") -> DataFrame:
    """``measure - lag(measure)`` per key over ``period``.  Meant for an
    aggregated table (one row per key and period), so a key's window holds
    only its periods."""
    w = Window.partitionBy(*key).orderBy(period)
    prev = F.lag(measure).over(w)
    return agg.withColumns({prev_col: prev, change_col: F.col(measure) - prev})


def ratio(num, den, digits: int = 4) -> Column:
    """num / den rounded; NULL when den is 0 or NULL."""
    n = num if isinstance(num, Column) else F.col(num)
    d = den if isinstance(den, Column) else F.col(den)
    return F.round(F.try_divide(n.cast("double"), d.cast("double")), digits)


def weather_vs_requests(requests: DataFrame, observations: DataFrame, demographics: DataFrame,
                        req_borough: str = "borough", req_ts: str = "created_at",
                        obs_borough: str = "borough", obs_ts: str = "observation_timestamp",
                        temp_col: str = "temp_celsius", obs_zone: str | None = None) -> DataFrame:
    """Per borough: days with requests, request count, Pearson correlation of
    daily request volume with daily mean temperature (rounded to 6 places),
    and the borough's demographics.

    ``obs_zone``: when request times are local wall-clock and observation
    times UTC, observations are put on the local day of that zone first.

    Both feeds are reduced to (borough, day) first (partial aggregation), so
    the join is between two tables of at most boroughs x days rows and the
    planner (AQE) broadcasts or shuffles them by their real size."""
    req_daily = (requests
                 .select(X.normalise_borough(F.col(req_borough)).alias("borough"),
                         F.to_date(F.col(req_ts)).alias("day"))
                 .groupBy("borough", "day").agg(F.count(F.lit(1)).alias("n_req")))
    obs_daily = (observations
                 .select(X.normalise_borough(F.col(obs_borough)).alias("borough"),
                         (X.local_day(F.col(obs_ts), obs_zone) if obs_zone
                          else F.to_date(F.col(obs_ts))).alias("day"),
                         F.col(temp_col).alias("t"))
                 .groupBy("borough", "day").agg(F.avg("t").alias("mean_temp")))
    per_borough = (req_daily.join(obs_daily, ["borough", "day"], "left")
                   .groupBy("borough")
                   .agg(F.count(F.lit(1)).alias("n_days"),
                        F.sum("n_req").alias("requests"),
                        F.round(F.corr(F.col("n_req").cast("double"), "mean_temp"), 6)
                        .alias("corr_temp")))
    demo = demographics.withColumn("borough", X.normalise_borough(F.col("borough")))
    return per_borough.join(demo, "borough", "left")
