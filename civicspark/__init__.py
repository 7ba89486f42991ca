"""civicspark — Spark-native ingestion and analytics for city feeds.

Three feeds (service requests, weather observations, demographic surveys)
are read from landing payloads, flattened, cleaned and typed with native
Column expressions, given lineage columns and written as append-only
tables or through a keyed upsert.  Analytics on top (latest row, SCD2,
year-over-year change, correlation of weather with request volume) are
DataFrame plans; streaming forms use Structured Streaming.
"""

__version__ = "0.1.0"
