"""Sources and sinks: CSV, Parquet, GeoJSON feed documents, and the events fixture."""

from seisflow.sources.catalogue import (  # noqa: F401
    read_catalogue_csv, write_catalogue_csv, read_catalogue_parquet,
    write_catalogue_parquet, conform, require_rows,
)
from seisflow.sources.geojson import flatten_feed, read_feed, feed_from_catalogue, write_feed  # noqa: F401
from seisflow.sources.fixture import catalogue_from_events, load_events, load_catalogue  # noqa: F401
