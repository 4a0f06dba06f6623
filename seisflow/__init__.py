"""seisflow: Spark-native analytics for seismic-event catalogues.

Every operator is a pure function ``f(df, **params) -> DataFrame`` built from
the DataFrame API, so Catalyst can push filters and projections into the scan,
plan partial aggregation, and pick join strategies at runtime (AQE).
"""

from seisflow.schema import CATALOGUE_SCHEMA, FEED_SCHEMA  # noqa: F401
from seisflow.session import build_session, checkpoint_dir, scratch_path  # noqa: F401

__version__ = "0.1.0"
