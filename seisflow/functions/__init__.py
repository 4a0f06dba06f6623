"""Column-level helpers (JVM-side expressions only; no Python UDFs)."""

from seisflow.functions.scalars import *  # noqa: F401,F403
from seisflow.functions.display import *  # noqa: F401,F403
