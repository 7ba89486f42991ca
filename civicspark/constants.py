"""Fixed values that must equal the source system's for identical results.

Everything here is plain data: table contracts, lookups, defaults and
workload parameters of the three feeds.
"""

# --- fixed values: workload parameters -------------------------------------
PAGE_SIZE = 50_000            # rows per request-feed page
INSERT_BATCH_SIZE = 5_000     # rows per load batch (batch report)
HISTORICAL_DAYS = 90          # look-back of mode "historical"
INCREMENTAL_DAYS = 3          # look-back of mode "incremental"
LOOKBACK_DAYS = {"historical": HISTORICAL_DAYS, "incremental": INCREMENTAL_DAYS}
DEFAULT_MODE = "incremental"
SURVEY_YEAR = 2022
DEFAULT_STATE_FIPS = "36"
UNKNOWN_BOROUGH = "Unknown"

# --- fixed values: lineage source tags --------------------------------------
SOURCE_REQUESTS = "nyc_open_data_311"
SOURCE_WEATHER = "openweather_api"
SOURCE_CENSUS = "us_census_bureau_acs5"

# --- fixed values: request feed column list, in target order ----------------
REQUEST_COLUMNS = [
    "unique_key", "created_date", "closed_date", "complaint_type", "descriptor",
    "incident_zip", "incident_address", "city", "borough", "latitude", "longitude",
    "status", "resolution_description", "agency", "agency_name",
]

# --- fixed values: county FIPS code -> borough (state 36) -------------------
COUNTY_BOROUGH = {
    "061": "Manhattan",
    "005": "Bronx",
    "047": "Brooklyn",
    "081": "Queens",
    "085": "Staten Island",
}

# --- fixed values: survey variable code -> column name ----------------------
SURVEY_VARIABLES = {
    "B01003_001E": "total_population",
    "B19013_001E": "median_household_income",
    "B17001_002E": "population_below_poverty",
    "B25001_001E": "total_housing_units",
    "B08006_001E": "total_workers_commuting",
}

# --- fixed values: borough centre coordinates (weather lookup) --------------
BOROUGH_CENTRES = [
    ("Manhattan", 40.7831, -73.9712),
    ("Brooklyn", 40.6782, -73.9442),
    ("Queens", 40.7282, -73.7949),
    ("Bronx", 40.8448, -73.8648),
    ("Staten Island", 40.5795, -74.1502),
]

# --- table comments (descriptive only; not compared) -----------------------
COMMENT_REQUESTS = "Raw city service requests, appended per load."
COMMENT_WEATHER = "Raw weather observations per borough, appended per load."
COMMENT_CENSUS = "Raw survey estimates per borough and year; keyed upsert; feeds the SCD2 dimension."
