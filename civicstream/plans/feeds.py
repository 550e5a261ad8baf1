"""Telemetry feeds derived from the driver tables.

The driver ships TPC-H-like tables plus an ``events`` table (event_id, ts, user_id,
event_type, value with 2 decimals, props '{"k": 0..99}'). The four telemetry feeds are
column maps of ``events`` — every feed row is one event row, so each feed grows with
the table. ``k`` drives fault injection (a few percent per rule), like a generator
with a fixed seed. ``nation`` x ``region`` gives the route schedule lookup.

Each map exists twice, as DataFrame code and as DuckDB SQL, so the oracle re-derives
the same feed independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.schemas import TOPICS, topic_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


K = "CAST(get_json_object(props, '$.k') AS INT)"
COMMON = ["event_id AS record_id", "ts AS event_time"]

# Column maps (Spark SQL), one list per feed; ``_k`` is extracted once per row.
SPARK_FEEDS = {
    "bus_gps": [
        "concat('B', CAST(user_id AS STRING)) AS bus_id",
        "concat('R', CAST(user_id DIV 5 AS STRING)) AS route_id",
        "CASE WHEN _k = 97 THEN CAST(NULL AS DOUBLE) WHEN _k = 98 THEN 91.0D "
        "ELSE 19.0D + value / 50000.0D END AS lat",
        "72.8D AS lon",
        "value / 4.0D AS speed_kmh",
        "CAST(_k + 2 AS DOUBLE) AS occupancy_pct",
    ],
    "air_quality": [
        "concat('S', CAST(user_id AS STRING)) AS sensor_id",
        "event_type AS zone",
        "value - 0.5D AS pm25",
        "value * 1.5D AS pm10",
        "_k / 2.0D AS no2",
        "CASE WHEN _k < 5 THEN CAST(NULL AS DOUBLE) ELSE value END AS aqi",
    ],
    "traffic_signals": [
        "concat('J', CAST(user_id AS STRING)) AS junction_id",
        "event_type AS zone",
        "CAST(_k * 3 AS DOUBLE) AS vehicle_count",
        "value * 1.25D AS avg_wait_sec",
        "CASE WHEN _k < 40 THEN 'GREEN' WHEN _k < 80 THEN 'RED' WHEN _k < 98 THEN 'AMBER' "
        "ELSE 'FLASHING' END AS signal_phase",
    ],
    "smart_meters": [
        "concat('M', CAST(user_id AS STRING)) AS meter_id",
        "event_type AS ward_id",
        "value - 1.0D AS kwh_reading",
        "181.0D + 0.8D * _k AS voltage",
        "0.75D + value / 1000.0D AS power_factor",
    ],
}


def _derive(e: DataFrame, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return e.selectExpr("*", f"{K} AS _k").selectExpr(*SPARK_FEEDS[name], *COMMON, *extra)


# Message key of a GPS fix: absent for a few records (k < 3), where consumers fall back
# to the payload's route id.
GPS_KEY = "CASE WHEN _k < 3 THEN CAST(NULL AS STRING) ELSE concat('R', CAST(user_id DIV 5 AS STRING)) END AS key"


def bus_gps_keyed(e: DataFrame) -> DataFrame:
    return _derive(e, "bus_gps", (GPS_KEY,))


def bus_gps(e: DataFrame) -> DataFrame:
    return _derive(e, "bus_gps")


def air_quality(e: DataFrame) -> DataFrame:
    return _derive(e, "air_quality")


def traffic_signals(e: DataFrame) -> DataFrame:
    return _derive(e, "traffic_signals")


def smart_meters(e: DataFrame) -> DataFrame:
    return _derive(e, "smart_meters")


FEEDS = {"bus_gps": bus_gps, "air_quality": air_quality,
         "traffic_signals": traffic_signals, "smart_meters": smart_meters}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FEEDS[name](table(spark, sf_dir, "events"))


def all_feeds(e: DataFrame) -> DataFrame:
    """The records of all four feeds from one scan: ``feed``, and the columns of every feed (null
    where a feed has none of that name)."""
    fields = {n: dict(reversed(x.rsplit(" AS ", 1)) for x in maps) for n, maps in SPARK_FEEDS.items()}
    kinds = {n: dict(feed(e).dtypes) for n, feed in FEEDS.items()}
    names = list(dict.fromkeys(c for maps in fields.values() for c in maps))
    kind = {c: next(k[c] for k in kinds.values() if c in k) for c in names}
    rows = ", ".join("named_struct('feed', '{}', {})".format(n, ", ".join(
        f"'{c}', CAST({maps.get(c, 'NULL')} AS {kind[c]})" for c in names)) for n, maps in fields.items())
    return e.selectExpr("*", f"{K} AS _k").selectExpr(*COMMON, f"inline(array({rows}))")


def route_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route lookup: one route per nation, terminal = its region."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("route_id"),
        F.col("n_name").alias("route_name"),
        F.col("r_name").alias("terminal"),
        F.concat(F.lit("2024-01-01T06:"), F.lpad((F.col("n_nationkey") * 2).cast("string"), 2, "0"),
                 F.lit(":00Z")).alias("scheduled_arrival_time"))


def envelope(df: DataFrame, feed_name: str) -> DataFrame:
    """Message envelope of a feed as the report operators see it: key = the feed's key
    field, partition = record id modulo the topic's partition count, offset = record id
    (increasing in time, not dense), timestamp = event time."""
    parts = {t: p for t, p, _, _ in TOPICS}[feed_name]
    key_field = {t: kf for t, _, _, kf in TOPICS}[feed_name]
    return df.select(F.col(key_field).alias("key"),
                     F.lit(topic_name(feed_name)).alias("topic"),
                     F.pmod(F.col("record_id"), F.lit(parts)).cast("int").alias("partition"),
                     F.col("record_id").alias("offset"),
                     F.col("event_time").alias("timestamp"))


# --------------------------------------------------------------------------- SQL side
SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

SQL_FEEDS = {
    "bus_gps": f"""
        SELECT 'B' || CAST(user_id AS VARCHAR) AS bus_id,
               'R' || CAST(user_id // 5 AS VARCHAR) AS route_id,
               CASE WHEN {SQL_K} = 97 THEN NULL WHEN {SQL_K} = 98 THEN 91.0::DOUBLE
                    ELSE 19.0::DOUBLE + value / 50000.0::DOUBLE END AS lat,
               72.8::DOUBLE AS lon,
               value / 4.0::DOUBLE AS speed_kmh,
               CAST({SQL_K} + 2 AS DOUBLE) AS occupancy_pct,
               event_id AS record_id, ts AS event_time
        FROM events""",
    "air_quality": f"""
        SELECT 'S' || CAST(user_id AS VARCHAR) AS sensor_id, event_type AS zone,
               value - 0.5::DOUBLE AS pm25, value * 1.5::DOUBLE AS pm10,
               {SQL_K} / 2.0::DOUBLE AS no2,
               CASE WHEN {SQL_K} < 5 THEN NULL ELSE value END AS aqi,
               event_id AS record_id, ts AS event_time
        FROM events""",
    "traffic_signals": f"""
        SELECT 'J' || CAST(user_id AS VARCHAR) AS junction_id, event_type AS zone,
               CAST({SQL_K} * 3 AS DOUBLE) AS vehicle_count,
               value * 1.25::DOUBLE AS avg_wait_sec,
               CASE WHEN {SQL_K} < 40 THEN 'GREEN' WHEN {SQL_K} < 80 THEN 'RED'
                    WHEN {SQL_K} < 98 THEN 'AMBER' ELSE 'FLASHING' END AS signal_phase,
               event_id AS record_id, ts AS event_time
        FROM events""",
    "smart_meters": f"""
        SELECT 'M' || CAST(user_id AS VARCHAR) AS meter_id, event_type AS ward_id,
               value - 1.0::DOUBLE AS kwh_reading,
               181.0::DOUBLE + 0.8::DOUBLE * {SQL_K} AS voltage,
               0.75::DOUBLE + value / 1000.0::DOUBLE AS power_factor,
               event_id AS record_id, ts AS event_time
        FROM events""",
}

SQL_ROUTES = """
    SELECT 'R' || CAST(n_nationkey AS VARCHAR) AS route_id, n_name AS route_name,
           r_name AS terminal,
           '2024-01-01T06:' || lpad(CAST(n_nationkey * 2 AS VARCHAR), 2, '0') || ':00Z'
               AS scheduled_arrival_time
    FROM nation JOIN region ON n_regionkey = r_regionkey"""
