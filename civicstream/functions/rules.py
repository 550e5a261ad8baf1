"""VAL-1..4: ordered validation rules as one CASE WHEN chain per feed (no UDF).

The first failing rule wins. Every predicate is written so that a null operand fails
the rule explicitly (``isNull() | ...``), never by SQL three-valued accident.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicstream.schemas import REASONS, SIGNAL_PHASES


# Failing predicates per feed, in evaluation order (SQL text; null operands fail
# explicitly). Each feed becomes ONE ``CASE WHEN`` expression parsed in a single call.
def _ids(a: str, b: str) -> str:
    """Null or empty (a falsy id) in either field."""
    return f"coalesce({a} = '', true) OR coalesce({b} = '', true)"


def _outside(c: str, lo, hi) -> str:
    return f"{c} IS NULL OR {c} < {lo} OR {c} > {hi}"


def _neg_or_null(c: str) -> str:
    return f"{c} IS NULL OR {c} < 0"


_PHASES = ", ".join(f"'{p}'" for p in SIGNAL_PHASES)
PREDICATES = {
    "bus_gps": [
        "lat IS NULL OR lon IS NULL",
        "NOT (lat BETWEEN -90 AND 90) OR NOT (lon BETWEEN -180 AND 180)",
        _outside("speed_kmh", 0, 120),
        _outside("occupancy_pct", 0, 100),
        _ids("route_id", "bus_id"),
    ],
    "air_quality": [
        "aqi IS NULL",
        "aqi < 0 OR aqi > 500",
        _neg_or_null("pm25"),
        _neg_or_null("pm10"),
        _neg_or_null("no2"),
        _ids("sensor_id", "zone"),
    ],
    "traffic_signals": [
        _neg_or_null("vehicle_count"),
        _outside("avg_wait_sec", 0, 600),
        f"NOT coalesce(signal_phase IN ({_PHASES}), false)",
        _ids("junction_id", "zone"),
    ],
    "smart_meters": [
        _neg_or_null("kwh_reading"),
        _outside("voltage", 180, 260),
        _outside("power_factor", 0, 1),
        _ids("meter_id", "ward_id"),
    ],
}


def rules_for(feed: str) -> list[tuple[str, str]]:
    """Ordered (reason, failing-predicate SQL) pairs for one feed."""
    if feed not in PREDICATES:
        raise ValueError(f"unknown feed {feed!r}")
    return list(zip(REASONS[feed], PREDICATES[feed]))


def error_reason_sql(rules: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN coalesce({pred}, false) THEN '{reason}'" for reason, pred in rules)
    return f"CASE {whens} ELSE CAST(NULL AS STRING) END"


def error_reason(rules: list[tuple[str, str]]) -> Column:
    """Nullable reason of the first failing rule (null = valid)."""
    return F.expr(error_reason_sql(rules))


def feed_error_reason(feed: str) -> Column:
    return error_reason(rules_for(feed))
