from civicspark.streaming.feeds import (  # noqa: F401
    daily_volume_stream, dedupe_redeliveries, land_requests, request_stream,
    upsert_latest_requests,
)
