from civicspark.sinks.tables import (  # noqa: F401
    append, create_table, load_feed, read_table_or_empty, upsert,
)
