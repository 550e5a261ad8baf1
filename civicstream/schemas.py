"""Schemas of the telemetry feeds and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the surveyed system's for equal results).
# Thresholds, windows and watermarks of the operators:
AQI_HAZARDOUS = 300.0             # AQI alert: strictly above
AQI_COOLDOWN_MS = 120_000         # AQI alert: re-alert only after 2 minutes
GRIDLOCK_WAIT_SEC = 180.0         # gridlock: wait strictly above
GRIDLOCK_CYCLES = 3               # gridlock: alert on the 3rd consecutive breach
BUNCHING_DISTANCE_M = 200.0       # bunching: distance at most
BUNCHING_DURATION_MS = 300_000    # bunching: proximity lasting at least 5 minutes
BUNCHING_FRESH_MS = 180_000       # bunching: other bus position at most 3 minutes old
EARTH_RADIUS_M = 6_371_000.0
UNHEALTHY_AQI = 150.0             # advisory: rolling average strictly above
WARD_WINDOW = "15 minutes"
WARD_WATERMARK = "45 minutes"
ADVISORY_WINDOW = "10 minutes"
ADVISORY_SLIDE = "1 minute"
ADVISORY_WATERMARK = "5 minutes"
DETECTOR_WATERMARK = "30 seconds"
DLQ_REPORT_WINDOW = "5 minutes"
LATEST_PER_TOPIC = 120
SIGNAL_PHASES = ("GREEN", "RED", "AMBER")
# Severity / incident type labels:
AQI_INCIDENT = ("AQI_EMERGENCY", "HAZARDOUS")
GRIDLOCK_INCIDENT = ("TRAFFIC_GRIDLOCK", "HIGH")
BUNCHING_INCIDENT = ("BUS_BUNCHING", "MEDIUM")
# Dead-letter reasons, in evaluation order per feed:
REASONS = {
    "bus_gps": ["NULL_COORDINATES", "IMPOSSIBLE_GPS_COORDINATES", "SPEED_OUT_OF_RANGE",
                "OCCUPANCY_OUT_OF_RANGE", "MISSING_ID_FIELD"],
    "air_quality": ["NULL_AQI", "AQI_OUT_OF_RANGE", "NEGATIVE_OR_MISSING_PM25",
                    "NEGATIVE_OR_MISSING_PM10", "NEGATIVE_OR_MISSING_NO2", "MISSING_ID_FIELD"],
    "traffic_signals": ["NEGATIVE_VEHICLE_COUNT", "WAIT_TIME_OUT_OF_RANGE",
                        "INVALID_SIGNAL_PHASE", "MISSING_ID_FIELD"],
    "smart_meters": ["NEGATIVE_KWH_READING", "VOLTAGE_OUT_OF_RANGE",
                     "POWER_FACTOR_OUT_OF_RANGE", "MISSING_ID_FIELD"],
}
MALFORMED_JSON = "MALFORMED_JSON"  # ours: a line that is not a JSON object
# Topic catalog: feed, partitions, retention in ms, message key field.
TOPICS = [
    ("bus_gps", 6, 86_400_000, "route_id"),
    ("traffic_signals", 6, 604_800_000, "junction_id"),
    ("air_quality", 3, 7_776_000_000, "sensor_id"),
    ("smart_meters", 4, 31_536_000_000, "ward_id"),
    ("dlq", 3, 2_592_000_000, None),
]
# ---------------------------------------------------------------------------

TOPIC_PREFIX = "city."


def topic_name(feed: str) -> str:
    return TOPIC_PREFIX + feed


S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw parse schemas: integer fields are parsed as DOUBLE so that ``120.0`` is accepted
# the way a numeric comparison accepts it; they are cast after validation.
RAW_SCHEMAS = {
    "bus_gps": _st(("bus_id", S), ("route_id", S), ("lat", D), ("lon", D),
                   ("speed_kmh", D), ("occupancy_pct", D), ("timestamp", S)),
    "traffic_signals": _st(("junction_id", S), ("zone", S), ("vehicle_count", D),
                           ("avg_wait_sec", D), ("signal_phase", S), ("timestamp", S)),
    "air_quality": _st(("sensor_id", S), ("zone", S), ("pm25", D), ("pm10", D), ("no2", D),
                       ("aqi", D), ("timestamp", S)),
    "smart_meters": _st(("meter_id", S), ("ward_id", S), ("kwh_reading", D), ("voltage", D),
                        ("power_factor", D), ("timestamp", S)),
}

INT_FIELDS = {"bus_gps": ["occupancy_pct"], "traffic_signals": ["vehicle_count"]}

KEY_FIELD = {t[0]: t[3] for t in TOPICS}

ROUTE_SCHEDULE = _st(("route_id", S), ("route_name", S), ("terminal", S),
                     ("scheduled_arrival_time", S))
ZONE_PROFILE = _st(("zone", S), ("zone_name", S), ("population", I), ("num_schools", I))

# The message envelope every source produces (same shape as the Kafka source).
ENVELOPE = T.StructType([
    T.StructField("key", S, True),
    T.StructField("value", S, True),
    T.StructField("topic", S, True),
    T.StructField("partition", I, True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

INCIDENT_COLUMNS = [
    ("incident_type", S), ("severity", S), ("source_timestamp", S),
    ("detected_at_event_time", T.LongType()),
    ("sensor_id", S), ("zone", S), ("aqi", D),
    ("junction_id", S), ("consecutive_cycles_over_threshold", I), ("avg_wait_sec", D),
    ("route_id", S), ("bus_id_1", S), ("bus_id_2", S), ("distance_m", D),
    ("continuous_proximity_sec", T.LongType()),
]
