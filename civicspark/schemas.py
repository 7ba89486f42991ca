"""Target table contracts: column order, types, declared text lengths, defaults.

A contract is a list of ``Col`` entries.  From it we derive the Spark
``StructType`` (used to conform DataFrames before a write), the
``CREATE TABLE IF NOT EXISTS`` DDL (catalog tables) and the length
checks that the warehouse enforced with ``VARCHAR(n)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from civicspark import constants as C


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    max_len: int | None = None      # VARCHAR(n); None = unbounded / not text
    default: str | None = None      # SQL default expression

    @property
    def sql_type(self) -> str:
        if isinstance(self.dtype, T.StringType) and self.max_len:
            return f"VARCHAR({self.max_len})"
        return self.dtype.simpleString().upper()


S, D, TS, I = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.IntegerType()
NOW = "CAST(current_timestamp() AS TIMESTAMP_NTZ)"

# --- fixed values: requests_raw ---------------------------------------------
REQUESTS_RAW = [
    Col("unique_key", S, 50), Col("created_date", S, 50), Col("closed_date", S, 50),
    Col("complaint_type", S, 200), Col("descriptor", S, 500), Col("incident_zip", S, 20),
    Col("incident_address", S, 500), Col("city", S, 100), Col("borough", S, 100),
    Col("latitude", S, 50), Col("longitude", S, 50), Col("status", S, 100),
    Col("resolution_description", S, 2000), Col("agency", S, 50), Col("agency_name", S, 200),
    Col("_ingested_at", TS, default=NOW), Col("_ingestion_mode", S, 20),
    Col("_source", S, 100, default=f"'{C.SOURCE_REQUESTS}'"),
]

# --- fixed values: weather_raw ----------------------------------------------
WEATHER_RAW = [
    Col("borough", S, 50), Col("city_name", S, 100), Col("lat", D), Col("lon", D),
    Col("country", S, 10), Col("weather_main", S, 100), Col("weather_description", S, 200),
    Col("weather_icon", S, 20), Col("temp_celsius", D), Col("feels_like_celsius", D),
    Col("temp_min_celsius", D), Col("temp_max_celsius", D), Col("pressure_hpa", D),
    Col("humidity_pct", D), Col("visibility_meters", D), Col("wind_speed_ms", D),
    Col("wind_direction_deg", D), Col("cloudiness_pct", D), Col("rain_1h_mm", D),
    Col("snow_1h_mm", D), Col("observation_timestamp", TS), Col("sunrise_timestamp", TS),
    Col("sunset_timestamp", TS), Col("_ingested_at", TS, default=NOW),
    Col("_source", S, 100, default=f"'{C.SOURCE_WEATHER}'"),
]

# --- fixed values: census_raw -----------------------------------------------
CENSUS_RAW = [
    Col("borough", S, 50), Col("county_fips", S, 10), Col("state_fips", S, 10),
    Col("survey_year", I), Col("total_population", D), Col("median_household_income", D),
    Col("population_below_poverty", D), Col("total_housing_units", D),
    Col("total_workers_commuting", D), Col("poverty_rate_pct", D),
    Col("_ingested_at", TS, default=NOW),
    Col("_source", S, 100, default=f"'{C.SOURCE_CENSUS}'"),
]

CENSUS_KEY = ["borough", "survey_year"]
# columns a matched upsert overwrites; the rest keep their stored values
CENSUS_UPDATE = [
    "total_population", "median_household_income", "population_below_poverty",
    "total_housing_units", "total_workers_commuting", "poverty_rate_pct", "_ingested_at",
]

CONTRACTS = {
    "requests_raw": (REQUESTS_RAW, C.COMMENT_REQUESTS),
    "weather_raw": (WEATHER_RAW, C.COMMENT_WEATHER),
    "census_raw": (CENSUS_RAW, C.COMMENT_CENSUS),
}


def struct_type(contract: list[Col]) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.dtype, True) for c in contract])


def max_lengths(contract: list[Col]) -> dict[str, int]:
    return {c.name: c.max_len for c in contract if c.max_len}


def create_table_ddl(name: str, contract: list[Col], comment: str,
                     location: str | None = None,
                     partitioned_by: list[str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with declared lengths, defaults and comment."""
    cols = ",\n  ".join(
        f"{c.name} {c.sql_type}" + (f" DEFAULT {c.default}" if c.default else "")
        for c in contract)
    part = f"\nPARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f"\nLOCATION '{location}'" if location else ""
    esc = comment.replace("'", "\\'")
    return (f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
            f"{part}{loc}\nCOMMENT '{esc}'")
