"""DET-1..3 batch detectors: hand-made cases and the alerts' definition on
random data (small time chunks force the cross-chunk carry paths)."""

import random

import pytest
from pyspark.sql import functions as F

from civicstream.operators import detect
from civicstream.operators.incidents import (aqi_incidents, gridlock_incidents,
                                             union_incidents)
from helpers import expected_bunching, expected_cooldown, expected_streaks

T0 = 1_782_885_600_000  # 2026-07-01T06:00:00Z in ms


def frame(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("event_time", F.timestamp_millis("t")).drop("t")


def aqi_rows(spark, seq, key="S1"):
    rows = [(key, T0 + int(s * 1000), i, v) for i, (s, v) in enumerate(seq)]
    return frame(spark, rows, "sensor_id string, t long, tie long, aqi double")


def test_cooldown_chain(spark):
    df = aqi_rows(spark, [(s, 301.0) for s in (0, 60, 119, 120, 239, 240)])
    got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "tie")
    assert sorted(r.tie for r in got.collect()) == [0, 3, 5]


def test_cooldown_edges(spark):
    df = aqi_rows(spark, [(0, 300.0), (10, None), (20, 300.0001)])
    got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "tie").collect()
    assert [r.tie for r in got] == [2]


def wait_rows(spark, waits, key="J1"):
    rows = [(key, T0 + i * 90_000, i, w) for i, w in enumerate(waits)]
    return frame(spark, rows, "junction_id string, t long, tie long, avg_wait_sec double")


@pytest.mark.parametrize("waits,expected", [
    ([181, 181, 181, 181], [2]),
    ([181, 181, 180, 181, 181, 181], [5]),
    ([181, None, 181, 181], [3]),
    ([181, 181, 181, 100, 181, 181, 181], [2, 6]),
    ([180, 180, 180], []),
])
def test_gridlock(spark, waits, expected):
    df = wait_rows(spark, [None if w is None else float(w) for w in waits])
    got = detect.streak_alerts(df, "junction_id", "event_time", "avg_wait_sec", "tie")
    rows = got.collect()
    assert sorted(r.tie for r in rows) == expected
    assert all(r.consecutive_cycles_over_threshold == 3 for r in rows)


def gps_rows(spark, fixes):
    """fixes: (route, bus, seconds, lat, lon)."""
    rows = [(r, b, T0 + int(s * 1000), i, la, lo) for i, (r, b, s, la, lo) in enumerate(fixes)]
    return frame(spark, rows, "route_id string, bus_id string, t long, tie long, lat double, lon double")


LAT, LON = 19.0, 72.8
D100 = 100 / 111_195  # ~100 m of latitude in degrees
D500 = 500 / 111_195


def bunch(spark, fixes):
    df = gps_rows(spark, fixes)
    return detect.proximity_alerts(df, "route_id", "bus_id", "event_time", "lat", "lon", "tie")


def test_bunching_alert_after_five_minutes(spark):
    fixes = []
    for m in range(7):
        fixes.append(("R1", "B1", m * 60, LAT, LON))
        fixes.append(("R1", "B2", m * 60 + 1, LAT + D100, LON))
    got = bunch(spark, fixes).collect()
    assert len(got) == 1
    a = got[0]
    # clock starts at B2's first fix (1 s), the alert is the first fix >= 300 s later
    assert a.continuous_proximity_sec == 300 and (a.bus_id_1, a.bus_id_2) == ("B2", "B1")
    assert a.distance_m == pytest.approx(100.0, abs=0.2)


def test_bunching_reset_when_apart(spark):
    fixes = []
    for m in range(12):
        lat2 = LAT + (D500 if m == 4 else D100)
        fixes.append(("R1", "B1", m * 60, LAT, LON))
        fixes.append(("R1", "B2", m * 60 + 1, lat2, LON))
    got = bunch(spark, fixes).collect()
    # the far fix at 241 s (and B1's view of it at 300 s) clears the clock; it restarts
    # at 301 s, so the alert comes at 601 s, not at 301 s
    assert [(r.detected_at_event_time - T0, r.continuous_proximity_sec) for r in got] == \
        [(601_000, 300)]


def test_bunching_stale_keeps_streak(spark):
    fixes = [("R1", "B1", 0, LAT, LON), ("R1", "B2", 10, LAT + D100, LON),
             # B1 silent for 5 minutes: B2's fixes are compared with a stale position
             ("R1", "B2", 250, LAT + D100, LON),
             ("R1", "B1", 320, LAT, LON)]
    got = bunch(spark, fixes).collect()
    assert [(r.bus_id_1, r.continuous_proximity_sec) for r in got] == [("B1", 310)]


def test_bunching_needs_same_route(spark):
    fixes = []
    for m in range(7):
        fixes.append(("R1", "B1", m * 60, LAT, LON))
        fixes.append(("R2", "B2", m * 60 + 1, LAT + D100, LON))
    assert bunch(spark, fixes).count() == 0


@pytest.mark.parametrize("seed,chunk_ms,cooldown", [
    (1, 86_400_000, 120_000), (2, 420_000, 120_000), (3, 61_000, 120_000), (9, 1_000, 120_000),
    (10, 300_000, 1), (11, 300_000, 900_000), (12, None, 120_000)])
def test_cooldown_matches_definition(spark, seed, chunk_ms, cooldown):
    rnd = random.Random(seed)
    rows = []
    for i in range(1500):
        k = f"S{rnd.randrange(6)}"
        t = T0 + rnd.randrange(0, 3 * 3600) * 1000 + rnd.choice([0, 0, 500])
        v = rnd.choice([None, rnd.uniform(250, 350), 301.0])
        rows.append((k, t, i, v))
    df = frame(spark, rows, "sensor_id string, t long, tie long, aqi double")
    got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "tie", chunk_ms=chunk_ms,
                                 cooldown_ms=cooldown)
    assert {(r.sensor_id, r.tie) for r in got.collect()} == expected_cooldown(rows, 300.0, cooldown)


@pytest.mark.parametrize("batch", [1, 7])
def test_cooldown_groups_over_many_batches(spark, batch):
    """Chunks and keys that end within an Arrow batch, at its end, or several batches later."""
    rnd = random.Random(batch)
    rows = [(rnd.choice([None, "S1", "S2", "S3"]), T0 + rnd.randrange(0, 3600) * 1000, i, 301.0) for i in range(300)]
    rows += [("S1", T0 + 5_000, 300 + i, 301.0) for i in range(30)]
    df = frame(spark, rows, "sensor_id string, t long, tie long, aqi double")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(batch))
    try:
        for chunk_ms, cooldown in ((60_000, 120_000), (600_000, 45_000), (60_000, 0)):
            got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "tie", chunk_ms=chunk_ms, cooldown_ms=cooldown)
            assert sorted((str(r.sensor_id), r.tie) for r in got.collect()) == sorted(
                (str(k), i) for k, i in expected_cooldown(rows, 300.0, cooldown)), (chunk_ms, cooldown)
    finally:
        spark.conf.set(conf, before)


@pytest.mark.parametrize("seed,chunk_ms,cycles", [(4, 86_400_000, 3), (5, 300_000, 3), (6, 45_000, 3), (12, 1_000, 3),
                                            (13, 20_000, 1), (14, 20_000, 6), (15, None, 3)])
def test_streak_matches_definition(spark, seed, chunk_ms, cycles):
    rnd = random.Random(seed)
    rows = []
    for i in range(2000):
        k = f"J{rnd.randrange(5)}"
        t = T0 + rnd.randrange(0, 3 * 3600) * 1000
        v = rnd.choice([None, 100.0, 181.0, 181.0, 250.0, 180.0])
        rows.append((k, t, i, v))
    df = frame(spark, rows, "junction_id string, t long, tie long, avg_wait_sec double")
    got = detect.streak_alerts(df, "junction_id", "event_time", "avg_wait_sec", "tie",
                               chunk_ms=chunk_ms, cycles=cycles)
    assert {(r.junction_id, r.tie) for r in got.collect()} == expected_streaks(rows, 180.0, cycles)


@pytest.mark.parametrize("seed,chunk_ms", [(7, 86_400_000), (8, 600_000), (13, 30_000), (14, None)])
def test_bunching_matches_definition(spark, seed, chunk_ms):
    rnd = random.Random(seed)
    rows = []
    for i in range(1200):
        route = f"R{rnd.randrange(2)}"
        bus = f"B{rnd.randrange(4)}"
        t = T0 + rnd.randrange(0, 2 * 3600) * 1000
        lat = LAT + rnd.choice([0.0, 0.0005, 0.001, 0.003, 0.0018])
        lon = LON + rnd.choice([0.0, 0.0005, 0.002])
        rows.append((route, bus, t, i, lat, lon))
    df = frame(spark, rows, "route_id string, bus_id string, t long, tie long, lat double, lon double")
    got = detect.proximity_alerts(df, "route_id", "bus_id", "event_time", "lat", "lon", "tie",
                                  chunk_ms=chunk_ms)
    want = expected_bunching(rows, 200.0, 300_000, 180_000)
    assert {(r.route_id, r.bus_id_1, r.bus_id_2, r.tie, r.continuous_proximity_sec)
            for r in got.collect()} == want
    assert len(want) > 0


def test_incident_union_shape(spark):
    a = detect.cooldown_alerts(aqi_rows(spark, [(0, 400.0)]), "sensor_id", "event_time", "aqi",
                               "tie").withColumn("zone", F.lit("Z01")).withColumn(
        "timestamp", F.lit("2026-07-01T06:00:00Z"))
    g = detect.streak_alerts(wait_rows(spark, [200.0] * 3), "junction_id", "event_time",
                             "avg_wait_sec", "tie").withColumn("zone", F.lit("Z01")).withColumn(
        "timestamp", F.lit("x"))
    u = union_incidents(aqi_incidents(a), gridlock_incidents(g))
    rows = u.collect()
    assert sorted(r.incident_type for r in rows) == ["AQI_EMERGENCY", "TRAFFIC_GRIDLOCK"]
    assert len(u.columns) == 15


def test_bunching_crowded_terminal_matches_definition(spark):
    """A hot cell: 30 buses of one route idle at a terminal, reporting every 3 s."""
    rnd = random.Random(21)
    rows, i = [], 0
    for s in range(0, 900, 3):
        for b in rnd.sample(range(30), 10):
            rows.append(("R1", f"B{b:02d}", T0 + s * 1000 + b, i,
                         LAT + 0.0002 * (b % 5), LON + 0.0002 * (b // 10)))
            i += 1
    df = frame(spark, rows, "route_id string, bus_id string, t long, tie long, lat double, lon double")
    got = detect.proximity_alerts(df, "route_id", "bus_id", "event_time", "lat", "lon", "tie")
    want = expected_bunching(rows, 200.0, 300_000, 180_000)
    assert len(want) > 100
    assert {(r.route_id, r.bus_id_1, r.bus_id_2, r.tie, r.continuous_proximity_sec)
            for r in got.collect()} == want


def test_null_and_repeated_ties(spark):
    """Alerts do not depend on offsets: none at all, or the same one twice."""
    rows = [("s1", f"2025-01-01 00:0{i}:00", 200.0, tie) for i, tie in ((0, None), (0, None), (3, 7), (3, 7), (6, None))]
    df = spark.createDataFrame(rows, "sensor_id string, event_time string, aqi double, offset long") \
        .withColumn("event_time", F.to_timestamp("event_time"))
    got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "offset", threshold=150.0, cooldown_ms=120_000)
    assert sorted(str(r.event_time)[14:16] for r in got.collect()) == ["00", "03", "06"]
    forced = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "offset", threshold=150.0,
                                    cooldown_ms=240_000, chunk_ms=60_000)
    assert sorted(str(r.event_time)[14:16] for r in forced.collect()) == ["00", "06"]


def test_rows_without_a_time_do_not_count(spark):
    rows = [("j", "2025-01-01 00:00:00", 99.0, 1), ("j", None, 99.0, 2), ("j", None, 99.0, 3)]
    df = spark.createDataFrame(rows, "j string, t string, w double, o long").withColumn("t", F.to_timestamp("t"))
    assert detect.streak_alerts(df, "j", "t", "w", "o", threshold=50.0, cycles=3).count() == 0


def test_a_null_key_is_a_key(spark):
    rows = [(k, T0 + i * 1000, i, 400.0) for i, k in enumerate([None, "a", None, "a"] * 30)]
    df = frame(spark, rows, "sensor_id string, t long, tie long, aqi double")
    got = detect.cooldown_alerts(df, "sensor_id", "event_time", "aqi", "tie", cooldown_ms=10_000, chunk_ms=7_000)
    assert {(r.sensor_id, r.tie) for r in got.collect()} == expected_cooldown(rows, 300.0, 10_000)


def test_gridlock_shuffles_the_feed_once(spark, tmp_dir):
    """One exchange of the feed, read by both branches, and one of the edges of the chunks."""
    wait_rows(spark, [200.0] * 5).write.parquet(tmp_dir + "/w")
    got = detect.streak_alerts(spark.read.parquet(tmp_dir + "/w"), "junction_id", "event_time", "avg_wait_sec", "tie")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(junction_id#") - plan.count("ReusedExchange") <= 2
    assert "ReusedExchange" in plan and "checkpoint" not in plan.lower()
