"""Column-expression helpers (native Spark expressions, no Python UDFs)."""

from civicstream.functions.geo import haversine_m, pair_key  # noqa: F401
from civicstream.functions.timecols import epoch_ms, event_time  # noqa: F401
