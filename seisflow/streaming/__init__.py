"""Structured Streaming: incremental ingest, de-duplication, watermarked counts."""

from seisflow.streaming.ingest import (  # noqa: F401
    event_stream, feed_stream, dedup_stream, daily_counts_stream, run_to_parquet, latest_revisions,
    upsert_batches,
)
