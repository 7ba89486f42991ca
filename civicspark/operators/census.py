"""Survey documents: header zip, cleaning, derived rate, county lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark import constants as C
from civicspark import schemas
from civicspark.functions import scalars as X


def clean(rows: DataFrame, ingested_at, survey_year: int = C.SURVEY_YEAR,
          data_col: str = "data", keep: list[str] | None = None) -> DataFrame:
    """Header-zipped rows -> ``census_raw`` rows (typed, sentinels nulled,
    poverty rate derived, county mapped to borough)."""
    m = F.col(data_col)
    county = X.get_or_default(m, "county", "")
    measures = {name: X.safe_float(m[code]) for code, name in C.SURVEY_VARIABLES.items()}
    out = rows.select(
        *(keep or []),
        F.coalesce(F.try_element_at(X.county_borough_map(), county),
                   F.lit(C.UNKNOWN_BOROUGH)).alias("borough"),
        county.alias("county_fips"),
        X.get_or_default(m, "state", C.DEFAULT_STATE_FIPS).alias("state_fips"),
        F.lit(survey_year).cast("int").alias("survey_year"),
        *[v.alias(k) for k, v in measures.items()],
    )
    out = out.withColumn("poverty_rate_pct",
                         X.guarded_rate("population_below_poverty", "total_population"))
    out = out.withColumns({"_ingested_at": X.as_of_literal(ingested_at),
                           "_source": F.lit(C.SOURCE_CENSUS)})
    return out.select(*(keep or []), *[c.name for c in schemas.CENSUS_RAW])


def filter_counties(df: DataFrame, county_col: str = "county_fips",
                    state_col: str = "state_fips", state: str = C.DEFAULT_STATE_FIPS) -> DataFrame:
    """Membership in the configured counties and equality on the state code."""
    return df.filter(F.col(county_col).isin(list(C.COUNTY_BOROUGH)) & (F.col(state_col) == state))


def borough_of_county(df: DataFrame, county_col: str = "county_fips") -> DataFrame:
    """Left lookup county -> borough with default ``Unknown`` (constant map:
    no join, no shuffle)."""
    return df.withColumn("borough", F.coalesce(
        F.try_element_at(X.county_borough_map(), F.col(county_col)), F.lit(C.UNKNOWN_BOROUGH)))
