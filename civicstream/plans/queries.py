"""Registered queries: the engine's operators run over the driver tables.

Each function takes (spark, sf_dir) and returns a DataFrame. Output column names match
the DuckDB oracle in ``oracle.py``. Detector parameters are scaled to the driver data
(``events`` has ~1 row per user per 11 hours, so windows are hours, not minutes); the
telemetry defaults live in ``schemas`` and are exercised by the fixture tests.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.operators import detect, dlq, enrich, incidents, ops, validate, windows
from civicstream.plans import feeds


ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
HOUR_MS = 3_600_000

# Driver-scale detector parameters.
AQI_THRESHOLD, AQI_COOLDOWN_MS = 60.0, 12 * HOUR_MS
WAIT_THRESHOLD, WAIT_CYCLES = 50.0, 3
BUNCH_DISTANCE_M, BUNCH_DURATION_MS, BUNCH_FRESH_MS = 200.0, 5 * HOUR_MS, 6 * HOUR_MS
ADVISORY_WIDTH, ADVISORY_SLIDE, ADVISORY_THRESHOLD = "10 hours", "1 hour", 60.0


def _tagged(spark, sf_dir, name) -> DataFrame:
    return validate.with_error_reason(feeds.feed(spark, sf_dir, name), name)


def _valid(spark, sf_dir, name, keep: list[str] | None = None) -> DataFrame:
    return validate.valid_rows(_tagged(spark, sf_dir, name), name, keep)


def _validate_q(name):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tagged(spark, sf_dir, name).select("record_id", "error_reason")
    q.__name__ = f"validate_{name}"
    return q


def _all_tagged(spark, sf_dir) -> DataFrame:
    """Records of all feeds with their reasons, from one scan of ``events``."""
    return validate.with_reason_by_feed(feeds.all_feeds(feeds.table(spark, sf_dir, "events")))


def _all_dlq(spark, sf_dir, *keep: str) -> DataFrame:
    kept = _all_tagged(spark, sf_dir).select(*keep, "source_topic", "error_reason")
    return validate.rows_where(kept, F.col("error_reason").isNotNull())


def split_counts(spark, sf_dir):
    return validate.split_counts_by_feed(_all_tagged(spark, sf_dir))


def dlq_messages(spark, sf_dir):
    return _all_dlq(spark, sf_dir, "key", "record_id").select("key", "source_topic", "error_reason", "record_id")


def dlq_by_reason(spark, sf_dir):
    return dlq.by_reason(_all_dlq(spark, sf_dir))


def dlq_by_topic(spark, sf_dir):
    return dlq.by_topic(_all_dlq(spark, sf_dir))


def dlq_windows(spark, sf_dir):
    return dlq.by_window(_all_dlq(spark, sf_dir, "event_time"), time_col="event_time")


def rule_hits(spark, sf_dir):
    return dlq.catalog_hits(dlq.rule_catalog(spark), _all_dlq(spark, sf_dir))


def ward_energy(spark, sf_dir):
    m = _valid(spark, sf_dir, "smart_meters",
               ["ward_id", "event_time", "kwh_reading", "power_factor", "voltage"])
    return windows.ward_energy(m, decimals=2,
                               pf_decimals=6)


def ward_totals(spark, sf_dir):
    s = ward_energy(spark, sf_dir).withColumn(
        "total_kwh_consumed", F.col("total_kwh_consumed").cast("decimal(18,2)"))
    return ops.key_totals(s).withColumn("total_kwh", F.col("total_kwh").cast("double"))


def zone_profile(air: DataFrame) -> DataFrame:
    """Zone attributes derived from the air feed: one row per zone."""
    return air.groupBy("zone").agg(
        F.upper("zone").alias("zone_name"),
        F.count(F.lit(1)).cast("int").alias("population"),
        F.count_distinct("sensor_id").cast("int").alias("num_schools"))


def health_advisories(spark, sf_dir):
    air = _valid(spark, sf_dir, "air_quality", ["zone", "sensor_id", "event_time", "aqi"])
    return windows.health_advisories(air, zone_profile(air), width=ADVISORY_WIDTH,
                                     slide=ADVISORY_SLIDE, threshold=ADVISORY_THRESHOLD,
                                     decimals=2)


def _gps_with_key(spark, sf_dir):
    """Valid GPS fixes with their message key (absent for a few records, where the
    payload route id is used instead, PRJ-6)."""
    e = feeds.table(spark, sf_dir, "events")
    gps = validate.valid_rows(validate.with_error_reason(feeds.bus_gps_keyed(e), "bus_gps"),
                              "bus_gps")
    return enrich.route_key(gps).withColumn("timestamp", F.date_format("event_time", ISO))


def eta_enriched(spark, sf_dir):
    return enrich.enrich_eta(_gps_with_key(spark, sf_dir), feeds.route_schedule(spark, sf_dir))


def eta_misses(spark, sf_dir):
    return enrich.enrich_misses(_gps_with_key(spark, sf_dir),
                                feeds.route_schedule(spark, sf_dir)).select(
        "record_id", "bus_id", "route_key")


def eta_counts(spark, sf_dir):
    return enrich.enrich_counters(_gps_with_key(spark, sf_dir), feeds.route_schedule(spark, sf_dir))


def aqi_alerts(spark, sf_dir):
    air = _valid(spark, sf_dir, "air_quality", ["sensor_id", "zone", "aqi", "record_id", "event_time"])
    a = detect.cooldown_alerts(air, "sensor_id", "event_time", "aqi", "record_id",
                               threshold=AQI_THRESHOLD, cooldown_ms=AQI_COOLDOWN_MS)
    return a.select("sensor_id", "zone", "aqi", "record_id", "event_time",
                    "detected_at_event_time")


def gridlock_alerts(spark, sf_dir):
    tr = _valid(spark, sf_dir, "traffic_signals",
                ["junction_id", "zone", "avg_wait_sec", "record_id", "event_time"])
    a = detect.streak_alerts(tr, "junction_id", "event_time", "avg_wait_sec", "record_id",
                             threshold=WAIT_THRESHOLD, cycles=WAIT_CYCLES)
    return a.select("junction_id", "zone", "avg_wait_sec", "consecutive_cycles_over_threshold",
                    "record_id", "event_time", "detected_at_event_time")


GPS_KEEP = ["route_id", "bus_id", "lat", "lon", "record_id", "event_time"]


def bunching_alerts(spark, sf_dir):
    gps = _valid(spark, sf_dir, "bus_gps", GPS_KEEP)
    a = detect.proximity_alerts(gps, "route_id", "bus_id", "event_time", "lat", "lon",
                                "record_id", distance_m=BUNCH_DISTANCE_M,
                                duration_ms=BUNCH_DURATION_MS, fresh_ms=BUNCH_FRESH_MS)
    return a.select("route_id", "bus_id_1", "bus_id_2", "distance_m",
                    "continuous_proximity_sec", F.col("tie").alias("record_id"),
                    "detected_at_event_time")


def incident_table(spark, sf_dir):
    iso = lambda df, c="event_time": df.withColumn("timestamp", F.date_format(c, ISO))
    a = incidents.aqi_incidents(iso(aqi_alerts(spark, sf_dir)))
    g = incidents.gridlock_incidents(iso(gridlock_alerts(spark, sf_dir)))
    gps = _valid(spark, sf_dir, "bus_gps", GPS_KEEP)
    b = detect.proximity_alerts(gps, "route_id", "bus_id", "event_time", "lat", "lon",
                                "record_id", distance_m=BUNCH_DISTANCE_M,
                                duration_ms=BUNCH_DURATION_MS, fresh_ms=BUNCH_FRESH_MS)
    b = b.withColumn("source_time", F.date_format("source_time", ISO))
    return incidents.union_incidents(a, g, incidents.bunching_incidents(b))


def _envelopes(spark, sf_dir) -> DataFrame:
    e = feeds.table(spark, sf_dir, "events")
    return reduce(lambda a, b: a.unionByName(b),
                  [feeds.envelope(fn(e), n) for n, fn in feeds.FEEDS.items()])


def latest_per_topic(spark, sf_dir):
    return ops.latest_per_topic(_envelopes(spark, sf_dir)).select(
        "topic", F.col("rank").cast("long").alias("rank"), "key", "partition", "offset",
        "timestamp")


def retention(spark, sf_dir):
    kept = ops.within_retention(_envelopes(spark, sf_dir), ops.topic_catalog(spark))
    return kept.groupBy("topic").agg(F.count(F.lit(1)).alias("kept"),
                                     F.min("timestamp").alias("oldest_kept"))


def consumer_lag(spark, sf_dir):
    """OPS-2 on the traffic topic: one group has read everything, one is a day behind.
    Lag = records at or past each group's committed offset, summed over partitions."""
    env = _traffic_env(spark, sf_dir)
    cut = _day_before_newest(env)
    fast = ops.committed_through(env, "high_priority")
    slow = ops.committed_through(env.where(F.col("timestamp") <= F.lit(cut)), "standard_priority")
    return ops.unread_records(env, fast.unionByName(slow))


def _day_before_newest(env: DataFrame):
    """The slow group's read position: one scalar, used as a literal filter (pushed
    into the scan) rather than a join against a one-row table."""
    newest = env.agg(F.max("timestamp")).first()[0]
    return newest - dt.timedelta(days=1)


def _traffic_env(spark, sf_dir) -> DataFrame:
    return feeds.envelope(feeds.traffic_signals(feeds.table(spark, sf_dir, "events")),
                          "traffic_signals")


def lag_series(spark, sf_dir):
    """OPS-3: lag of both groups at six samples spread over the topic's time span;
    the fast group has read up to each sample, the slow one a day less."""
    env = _traffic_env(spark, sf_dir)
    lo, hi = env.agg(F.min("timestamp"), F.max("timestamp")).first()
    span_us = (hi - lo) // dt.timedelta(microseconds=1)
    progress = []
    for k in range(6):
        st = lo + dt.timedelta(microseconds=span_us * k // 5)
        progress += [(k, "high_priority", st, st),
                     (k, "standard_priority", st, st - dt.timedelta(days=1))]
    return ops.lag_series(env, progress)


def consumer_counts(spark, sf_dir):
    """AGG-7: records processed per consumer. The standard group runs three consumers
    owning two partitions each and has read up to a day before the newest record;
    the high-priority group's single consumer has read everything."""
    env = _traffic_env(spark, sf_dir)
    slow = env.where(F.col("timestamp") <= F.lit(_day_before_newest(env))).select(
        F.concat(F.lit("standard_priority-"), (F.col("partition") / 2).cast("int") + 1)
        .alias("consumer"))
    fast = env.select(F.lit("high_priority").alias("consumer"))
    return ops.per_label_counts(fast.unionByName(slow))


def dedup(spark, sf_dir):
    """STR-6: every air reading delivered twice (at-least-once replay), then deduped on
    sensor and event time; returns what survives."""
    air = feeds.feed(spark, sf_dir, "air_quality")
    twice = air.unionByName(air)
    return ops.dedupe(twice, ["sensor_id", "event_time"]).select(
        "sensor_id", "event_time", "record_id")


def json_roundtrip(spark, sf_dir):
    """PRJ-1 / PRJ-4: serialise meter readings to JSON values, parse them back."""
    from civicstream.functions.jsoncols import parse_value, to_value
    m = feeds.feed(spark, sf_dir, "smart_meters").withColumn(
        "timestamp", F.date_format("event_time", ISO)).drop("event_time")
    msg = to_value(m, "ward_id")
    from civicstream.schemas import RAW_SCHEMAS
    back = parse_value(msg, RAW_SCHEMAS["smart_meters"])
    return back.select("key", "meter_id", "kwh_reading", "voltage", "power_factor",
                       "timestamp", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


QUERIES = {
    "validate_bus_gps": _validate_q("bus_gps"),
    "validate_air_quality": _validate_q("air_quality"),
    "validate_traffic_signals": _validate_q("traffic_signals"),
    "validate_smart_meters": _validate_q("smart_meters"),
    "split_counts": split_counts,
    "dlq_messages": dlq_messages,
    "dlq_by_reason": dlq_by_reason,
    "dlq_by_topic": dlq_by_topic,
    "dlq_windows": dlq_windows,
    "rule_hits": rule_hits,
    "ward_energy": ward_energy,
    "ward_totals": ward_totals,
    "health_advisories": health_advisories,
    "eta_enriched": eta_enriched,
    "eta_misses": eta_misses,
    "eta_counts": eta_counts,
    "aqi_alerts": aqi_alerts,
    "gridlock_alerts": gridlock_alerts,
    "bunching_alerts": bunching_alerts,
    "incidents": incident_table,
    "latest_per_topic": latest_per_topic,
    "retention": retention,
    "consumer_lag": consumer_lag,
    "lag_series": lag_series,
    "consumer_counts": consumer_counts,
    "dedup": dedup,
    "json_roundtrip": json_roundtrip,
}
