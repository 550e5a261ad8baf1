"""Structured Streaming: envelope file source, availableNow triggers, checkpoints."""

import json
import os
import random
import time

from pyspark.sql import functions as F

from civicstream.operators import detect
from civicstream.plans import streams
from civicstream.schemas import ENVELOPE, topic_name
from civicstream.session import STATE_ROWS, state_partitions
from civicstream.sources.topics import read_topic
from civicstream.streaming import jobs, stateful
from helpers import iso

ONCE = {"availableNow": True}


def put_messages(spark, root, feed, batches, key_field):
    """Write each batch of dict records as its own envelope file, in order."""
    path = f"{root}/{topic_name(feed)}"
    offset = 0
    for i, recs in enumerate(batches):
        rows = []
        for r in recs:
            value = r if isinstance(r, str) else json.dumps(r)
            key = None if isinstance(r, str) else r.get(key_field)
            rows.append((key, value, topic_name(feed), 0, offset, None))
            offset += 1
        df = spark.createDataFrame(rows, ENVELOPE)
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return root


def meter(sec, ward="W01", kwh=1.0, volt=230.0, pf=0.9):
    return dict(meter_id="M1", ward_id=ward, kwh_reading=kwh, voltage=volt, power_factor=pf,
                timestamp=iso(sec))


def valid_meters(spark, root, per_trigger=1):
    env = read_topic(spark, topic_name("smart_meters"), root=root, streaming=True,
                     max_per_trigger=per_trigger)
    t = jobs.parsed_feed(env, "smart_meters")
    return t.where(F.col("error_reason").isNull())


def test_ward_energy_dual_sink_closed_windows_restart(spark, tmp_dir):
    b1 = [meter(s, ward=w, kwh=float(s % 7)) for s in range(0, 3600, 60) for w in ("W01", "W02")]
    b2 = [meter(s, ward="W01", kwh=2.0) for s in range(3600, 7200, 60)]
    b3 = [meter(s, ward="W01", kwh=2.0) for s in range(7200, 10800, 60)]
    # Arrives after its window was emitted (Spark drops rows behind the previous
    # batch's watermark): dropped, the emitted 06:00 window keeps its value.
    late = [meter(60, ward="W01", kwh=100.0)]
    root = put_messages(spark, tmp_dir + "/in", "smart_meters", [b1, b2, b3, late], "ward_id")
    out = tmp_dir + "/out"
    q = jobs.ward_energy_job(valid_meters(spark, root), out + "/archive", out + "/topics",
                             out + "/ckpt", trigger=ONCE)
    q.awaitTermination()
    arc = spark.read.parquet(out + "/archive")
    topic = spark.read.parquet(f"{out}/topics/{topic_name('ward_energy_summary')}")
    # dual sink: same rows in both
    assert arc.count() == topic.count() > 0
    # closed windows only: end <= max event time - 45 min = 08:14 -> last closed ends 08:00
    assert arc.agg(F.max("window_end")).collect()[0][0].strftime("%H:%M") == "08:00"
    # the late row did not change the 06:00 window of W01
    w = arc.where("ward_id = 'W01'").orderBy("window_start").collect()[0]
    assert w.total_kwh_consumed == sum(float(s % 7) for s in range(0, 900, 60))
    # restart: a new file with later data advances the watermark, only new windows appear
    put_messages(spark, tmp_dir + "/in2", "smart_meters",
                 [[meter(s, ward="W01") for s in range(10800, 12600, 60)]], "ward_id")
    for f in os.listdir(f"{tmp_dir}/in2/{topic_name('smart_meters')}"):
        if f.endswith(".parquet"):
            os.rename(f"{tmp_dir}/in2/{topic_name('smart_meters')}/{f}",
                      f"{root}/{topic_name('smart_meters')}/z-{f}")
    q = jobs.ward_energy_job(valid_meters(spark, root), out + "/archive", out + "/topics",
                             out + "/ckpt", trigger=ONCE)
    q.awaitTermination()
    arc2 = spark.read.parquet(out + "/archive")
    keys = arc2.groupBy("ward_id", "window_start").count()
    assert keys.where("count > 1").count() == 0
    assert arc2.count() > arc.count()


def test_advisory_update_mode(spark, tmp_dir):
    recs = [dict(sensor_id="S1", zone="Z01", pm25=1.0, pm10=1.0, no2=1.0, aqi=200.0,
                 timestamp=iso(30)),
            dict(sensor_id="S2", zone="Z99", pm25=1.0, pm10=1.0, no2=1.0, aqi=400.0,
                 timestamp=iso(40))]
    root = put_messages(spark, tmp_dir + "/in", "air_quality", [recs], "sensor_id")
    env = read_topic(spark, topic_name("air_quality"), root=root, streaming=True)
    air = jobs.parsed_feed(env, "air_quality").where("error_reason IS NULL")
    prof = spark.createDataFrame([("Z01", "Andheri", 10, 2)],
                                 "zone string, zone_name string, population int, num_schools int")
    q = jobs.health_advisory_job(spark, air, prof, tmp_dir + "/topics", tmp_dir + "/ckpt",
                                 trigger=ONCE)
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('health_advisories')}")
    assert got.count() == 10 and got.select("key").distinct().collect()[0][0] == "Z01"


def test_dedup_within_watermark(spark, tmp_dir):
    r = dict(sensor_id="S1", zone="Z01", pm25=1.0, pm10=1.0, no2=1.0, aqi=20.0, timestamp=iso(0))
    r2 = {**r, "timestamp": iso(5)}
    root = put_messages(spark, tmp_dir + "/in", "air_quality", [[r, r], [r, r2]], "sensor_id")
    env = read_topic(spark, topic_name("air_quality"), root=root, streaming=True, max_per_trigger=1)
    d = jobs.dedup_stream(jobs.parsed_feed(env, "air_quality"), ["sensor_id", "event_time"])
    q = (d.writeStream.format("memory").queryName("dedup_t").option(
        "checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_t").count() == 2


def test_validation_job_routes_everything(spark, tmp_dir):
    good = meter(0)
    recs = [good, {**good, "voltage": 5.0}, "{not json", {**good, "ward_id": ""}]
    root = put_messages(spark, tmp_dir + "/in", "smart_meters", [recs], "ward_id")
    env = read_topic(spark, topic_name("smart_meters"), root=root, streaming=True)
    q = jobs.validation_job(env, "smart_meters", tmp_dir + "/topics", tmp_dir + "/ckpt",
                            trigger=ONCE)
    q.awaitTermination()
    ok = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('smart_meters')}")
    bad = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('dlq')}")
    assert ok.count() == 1 and bad.count() == 3
    reasons = sorted(json.loads(v)["error_reason"] for (v,) in bad.select("value").collect())
    assert reasons == ["MALFORMED_JSON", "MISSING_ID_FIELD", "VOLTAGE_OUT_OF_RANGE"]
    assert "{not json" in [json.loads(v)["original_record"] for (v,) in bad.select("value").collect()]
    metrics = [p.get("observedMetrics", {}) for p in q.recentProgress]
    counts = [m["smart_meters_counts"] for m in metrics if "smart_meters_counts" in m]
    assert counts and counts[0]["sent"] == 1 and counts[0]["routed_to_dlq"] == 3


def _split(rows, n):
    k = len(rows) // n + 1
    return [rows[i:i + k] for i in range(0, len(rows), k)]


def test_stateful_detectors_equal_batch(spark, tmp_dir):
    rnd = random.Random(11)
    air, traffic, gps = [], [], []
    for i in range(600):
        s = i * 5 + rnd.randrange(5)
        air.append(dict(sensor_id=f"S{rnd.randrange(3)}", zone="Z01", pm25=1.0, pm10=1.0,
                        no2=1.0, aqi=rnd.choice([250.0, 301.0, 350.0]), timestamp=iso(s)))
        traffic.append(dict(junction_id=f"J{rnd.randrange(3)}", zone="Z01", vehicle_count=3,
                            avg_wait_sec=rnd.choice([100.0, 181.0, 190.0]),
                            signal_phase="RED", timestamp=iso(s)))
        b = rnd.randrange(3)
        step = (s // (400 + 300 * b)) % 3  # positions drift: pairs close, then apart
        gps.append(dict(bus_id=f"B{b}", route_id="R1", lat=19.0 + 0.001 * step, lon=72.8,
                        speed_kmh=10.0, occupancy_pct=5, timestamp=iso(s)))
    cases = [("air_quality", air, "sensor_id", stateful.stream_aqi),
             ("traffic_signals", traffic, "junction_id", stateful.stream_gridlock),
             ("bus_gps", gps, "route_id", stateful.stream_bunching)]
    for feed, recs, key, fn in cases:
        root = put_messages(spark, f"{tmp_dir}/{feed}", feed, _split(recs, 4), key)
        env = read_topic(spark, topic_name(feed), root=root, streaming=True, max_per_trigger=1)
        valid = jobs.parsed_feed(env, feed).where("error_reason IS NULL")
        q = (fn(valid).writeStream.format("memory").queryName(f"s_{feed}")
             .option("checkpointLocation", f"{tmp_dir}/ck_{feed}").trigger(availableNow=True)
             .start())
        q.awaitTermination()
        stream = spark.table(f"s_{feed}")
        batch_in = jobs.parsed_feed(read_topic(spark, topic_name(feed), root=root), feed) \
            .where("error_reason IS NULL")
        wm = max(r["timestamp"] for r in recs)
        if feed == "air_quality":
            b = detect.cooldown_alerts(batch_in, key, "event_time", "aqi", "offset")
        elif feed == "traffic_signals":
            b = detect.streak_alerts(batch_in, key, "event_time", "avg_wait_sec", "offset")
        else:
            b = detect.proximity_alerts(batch_in, "route_id", "bus_id", "event_time", "lat",
                                        "lon", "offset")
        limit = stream.agg(F.max("detected_at_event_time")).collect()[0][0]
        bs = {r.detected_at_event_time for r in b.collect()}
        ss = {r.detected_at_event_time for r in stream.collect()}
        assert ss, feed
        # rows newer than the final watermark (max - 30 s) are still buffered; the join of
        # positions holds its pairs back for as long as a position is fresh
        assert ss == {t for t in bs if t <= limit}, (feed, wm)
        assert max(bs) - limit <= 30_000 + 5_000 + (180_000 if feed == "bus_gps" else 0)


def test_equal_alerts_in_1_4_and_16_micro_batches(spark, tmp_dir):
    """Rows of a file are out of order, and files overlap in time by less than the watermark."""
    rnd = random.Random(23)
    rows = []
    for i in range(900):
        at = i * 4
        bus = i % 4
        apart = (at // 900) % 3 == 2 and bus == 0
        rows.append((at, dict(bus_id=f"B{bus}", route_id="R1", lat=19.0 + (0.01 if apart else 0.0004 * bus), lon=72.8,
                              speed_kmh=9.0, occupancy_pct=5, timestamp=iso(at))))
    rows += [(3_650 + k, dict(bus_id="B9", route_id="R9", lat=1.0, lon=1.0, speed_kmh=9.0, occupancy_pct=5,
                              timestamp=iso(3_650 + k))) for k in (0, 400)]
    results = []
    for files in (1, 4, 16):
        size = -(-len(rows) // files)
        parts = []
        for k in range(0, len(rows), size):
            part = [r for _, r in sorted(rows[k:k + size], key=lambda r: r[0] + rnd.randrange(20))]
            parts.append(part)
        root = put_messages(spark, f"{tmp_dir}/n{files}", "bus_gps", parts, "route_id")
        env = read_topic(spark, topic_name("bus_gps"), root=root, streaming=True, max_per_trigger=1)
        seen = stateful.stream_bunching(jobs.parsed_feed(env, "bus_gps").where("error_reason IS NULL"))
        q = (seen.writeStream.format("parquet").option("path", f"{tmp_dir}/out{files}")
             .option("checkpointLocation", f"{tmp_dir}/ck{files}").trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.lastProgress["batchId"] >= files - 1
        got = spark.read.parquet(f"{tmp_dir}/out{files}")
        results.append(sorted((r.bus_id_1, r.bus_id_2, r.detected_at_event_time, r.continuous_proximity_sec,
                               r.source_timestamp) for r in got.collect()))
    assert len(results[0]) > 5 and results[0] == results[1] == results[2]


def test_stateful_restart_from_checkpoint(spark, tmp_dir):
    """Stop after two files, restart on the same checkpoint with two more: the alerts
    of both runs together equal one run over everything (state and buffered rows are
    restored from the checkpoint)."""
    rnd = random.Random(5)
    recs = []
    for i in range(400):
        recs.append(dict(junction_id=f"J{rnd.randrange(2)}", zone="Z01", vehicle_count=3,
                         avg_wait_sec=rnd.choice([100.0, 190.0, 190.0]), signal_phase="RED",
                         timestamp=iso(i * 7)))
    parts = _split(recs, 4)
    topic = topic_name("traffic_signals")

    def run(root, ck, name):
        env = read_topic(spark, topic, root=root, streaming=True, max_per_trigger=1)
        valid = jobs.parsed_feed(env, "traffic_signals").where("error_reason IS NULL")
        q = (stateful.stream_gridlock(valid).writeStream.format("parquet")
             .option("path", f"{tmp_dir}/{name}").option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    root = put_messages(spark, f"{tmp_dir}/a", "traffic_signals", parts[:2], "junction_id")
    run(root, f"{tmp_dir}/ck", "out")
    first = spark.read.parquet(f"{tmp_dir}/out").count()
    more = put_messages(spark, f"{tmp_dir}/b", "traffic_signals", parts[2:], "junction_id")
    for f in sorted(os.listdir(f"{more}/{topic}")):
        if f.endswith(".parquet"):
            os.rename(f"{more}/{topic}/{f}", f"{root}/{topic}/z-{f}")
    run(root, f"{tmp_dir}/ck", "out")
    both = {r.detected_at_event_time for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    root2 = put_messages(spark, f"{tmp_dir}/c", "traffic_signals", parts, "junction_id")
    run(root2, f"{tmp_dir}/ck2", "once")
    once = {r.detected_at_event_time for r in spark.read.parquet(f"{tmp_dir}/once").collect()}
    assert 0 < first < len(both)
    assert both == once


def test_enrichment_job_stream_static(spark, tmp_dir):
    fix = dict(bus_id="B1", route_id="R001", lat=19.0, lon=72.8, speed_kmh=20.0,
               occupancy_pct=40, timestamp=iso(0))
    recs = [fix, {**fix, "bus_id": "B2", "route_id": "R999"}]
    root = put_messages(spark, tmp_dir + "/in", "bus_gps", [recs], "route_id")
    # a message without key: the payload route is used
    extra = spark.createDataFrame([(None, json.dumps({**fix, "bus_id": "B3"}), topic_name("bus_gps"),
                                    0, 99, None)], ENVELOPE)
    extra.write.mode("append").parquet(f"{root}/{topic_name('bus_gps')}")
    env = read_topic(spark, topic_name("bus_gps"), root=root, streaming=True)
    gps = jobs.parsed_feed(env, "bus_gps").where("error_reason IS NULL")
    routes = spark.createDataFrame([("R001", "Line 1", "East Depot", "2026-07-01T06:17:43Z")],
                                   "route_id string, route_name string, terminal string, "
                                   "scheduled_arrival_time string")
    q = jobs.enrichment_job(gps, routes, tmp_dir + "/topics", tmp_dir + "/ck",
                            trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('bus_eta_enriched')}")
    got = sorted(json.loads(v)["bus_id"] for (v,) in out.select("value").collect())
    assert got == ["B1", "B3"]
    assert {k for (k,) in out.select("key").collect()} == {"R001"}
    m = [p["observedMetrics"]["enrichment"] for p in q.recentProgress
         if "enrichment" in p.get("observedMetrics", {})]
    assert (m[0]["joined"], m[0]["unmatched"], m[0]["missing_key"]) == (2, 1, 1)


def test_incident_sink_unkeyed(spark, tmp_dir):
    recs = [dict(sensor_id="S1", zone="Z01", pm25=1.0, pm10=1.0, no2=1.0, aqi=350.0,
                 timestamp=iso(s)) for s in (0, 60, 130, 400)]
    root = put_messages(spark, tmp_dir + "/in", "air_quality", [recs], "sensor_id")
    env = read_topic(spark, topic_name("air_quality"), root=root, streaming=True)
    air = jobs.parsed_feed(env, "air_quality").where("error_reason IS NULL")
    q = jobs.incidents_job(jobs.incidents_stream(air=air), tmp_dir + "/topics", tmp_dir + "/ck",
                           trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('incidents')}").collect()
    # 400 s is newer than the final watermark and stays buffered; 0 and 130 s fire
    assert sorted(json.loads(r.value)["source_timestamp"] for r in out) == [iso(0), iso(130)]
    assert all(r.key is None for r in out)
    assert all("junction_id" not in json.loads(r.value) for r in out)


def test_state_is_sized_by_cores_and_rows(spark):
    """Not by the session's setting, which a small stream would pay for in every micro-batch."""
    class Started:
        def awaitTermination(self):
            seen.append(spark.conf.get(key))

    key, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        feed = streams._Delivery(spark, {"air_quality": streams._messages(spark, "/root/testdata/sf0.001", "air_quality")})
        feed.run(Started)
        assert seen == [str(spark.sparkContext.defaultParallelism)] * streams.SLICES
        assert spark.conf.get(key) == "64"
        with state_partitions(spark, 100 * STATE_ROWS + 1):
            assert spark.conf.get(key) == "101"
    finally:
        spark.conf.set(key, before)
