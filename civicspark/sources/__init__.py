from civicspark.sources.tables import read_table, read_tables  # noqa: F401
from civicspark.sources.landing import (  # noqa: F401
    read_payloads, explode_request_pages, parse_weather_docs, explode_census_docs,
)
