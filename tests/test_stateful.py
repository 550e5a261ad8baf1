"""The streaming detectors' array code against loops over single rows, and how much they keep and make."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from civicstream.plans import streams
from civicstream.schemas import ENVELOPE, topic_name
from civicstream.sources.topics import read_topic
from civicstream.streaming import jobs, stateful
from helpers import iso


def in_parts(processor, rows, rnd):
    """What comes out for ``rows`` handed over in several parts of time."""
    names, carried, got, done = processor.row.names, processor.carry.empty_table(), [], None
    for upto in sorted(rnd.sample(range(1, 400), 4)) + [10**6]:
        ready = [r for r in rows if r["t"] <= upto and (done is None or r["t"] > done)]
        done = upto
        if not ready:
            continue
        rnd.shuffle(ready)
        out, after = processor.alerts(pa.Table.from_pylist(ready, processor.row), carried, upto)
        got += [r for t in out for r in t.cast(processor.out).to_pylist()]
        carried = stateful._unpack([stateful._pack(after.cast(processor.carry))], processor.carry)
    assert set(names) == set(rows[0])
    return got


def ordered(rows):
    return sorted(rows, key=lambda r: (r["t"], r["tie"] is not None, r["tie"] or 0))


@pytest.mark.parametrize("seed", range(6))
def test_cooldown_by_row(seed):
    rnd = random.Random(seed)
    rows = [dict(t=rnd.randrange(400), tie=i, aqi=rnd.choice([None, 1.0, 9.0, 10.0]), zone="Z", ts=str(i),
                 sensor_id=rnd.choice([None, "a", "b", "c"])) for i in range(200)]
    want, last = [], {}
    for r in ordered(rows):
        if r["aqi"] is not None and r["aqi"] > 5 and r["t"] - last.get(r["sensor_id"], -10**9) >= 25:
            last[r["sensor_id"]] = r["t"]
            want.append((r["sensor_id"] or "", r["t"], r["ts"]))
    got = in_parts(stateful.Cooldown(5, 25), rows, rnd)
    assert sorted((r["sensor_id"] or "", r["detected_at_event_time"], r["source_timestamp"]) for r in got) == sorted(want)


@pytest.mark.parametrize("seed", range(6))
def test_streak_by_row(seed):
    rnd = random.Random(seed)
    rows = [dict(t=rnd.randrange(400), tie=i, wait=rnd.choice([None, 1.0, 9.0, 9.0, 9.0]), zone="Z", ts=str(i),
                 junction_id=rnd.choice("abc")) for i in range(200)]
    want, run = [], {}
    for r in ordered(rows):
        if r["wait"] is not None:
            run[r["junction_id"]] = run.get(r["junction_id"], 0) + 1 if r["wait"] > 5 else 0
            if run[r["junction_id"]] == 3:
                want.append((r["junction_id"], r["t"], r["ts"]))
    got = in_parts(stateful.Streak(5, 3), rows, rnd)
    assert sorted((r["junction_id"], r["detected_at_event_time"], r["source_timestamp"]) for r in got) == sorted(want)


@pytest.mark.parametrize("seed", range(8))
def test_sightings_by_row(seed, monkeypatch):
    """Of each other bus the latest fix before, by time and tie; without a tie none of the same time."""
    monkeypatch.setattr(stateful, "BLOCK_ROWS", 50)
    rnd, fresh = random.Random(seed), 40
    fixes = [dict(t=rnd.randrange(400), tie=rnd.choice([None, i, i // 2]), route_id=rnd.choice("RS"), ts=str(i),
                  bus_id=rnd.choice("abcd"), lat=float(i), lon=0.0) for i in range(150)]
    rows = [{**f, "bucket": f["t"] // fresh + k, "copy": k == 1} for f in fixes for k in (0, 1)]
    tied = lambda f: (f["tie"] is not None, f["tie"] or 0)
    want = []
    for e in fixes:
        for other in set("abcd") - {e["bus_id"]}:
            seen = [p for p in fixes if p["bus_id"] == other and p["route_id"] == e["route_id"] and e["t"] - p["t"] <= fresh
                    and (p["t"] < e["t"] or p["t"] == e["t"] and None not in (p["tie"], e["tie"]) and p["tie"] < e["tie"])]
            if seen:
                p = max(seen, key=lambda p: (p["t"], tied(p)))
                want.append((e["lat"], other, p["t"], tied(p)))
    got = in_parts(stateful.Sightings(fresh), rows, rnd)
    assert sorted((r["lat"], r["other"], r["u"], (r["utie"] is not None, r["utie"] or 0)) for r in got) == sorted(want)


@pytest.mark.parametrize("seed", range(6))
def test_pair_clock_by_row(seed):
    rnd = random.Random(seed)
    rows = [dict(t=t, tie=t, route_id="R", bus_a="a", bus_b=rnd.choice("bc"), by_a=rnd.random() < 0.5, u=t - 1, utie=0,
                 distance=rnd.choice([1.0, 1.0, 1.0, 2.25, 99.0]), ts=str(t)) for t in rnd.sample(range(400), 120)]
    want, clocks = [], {}
    for r in ordered(rows):
        if r["distance"] > 50:
            clocks.pop(r["bus_b"], None)
            continue
        first, done = clocks.get(r["bus_b"], (r["t"], False))
        if r["t"] - first >= 10 and not done:
            pair = ("a", r["bus_b"]) if r["by_a"] else (r["bus_b"], "a")
            want.append((*pair, r["t"], round(r["distance"], 1), (r["t"] - first) // 1000))
            done = True
        clocks[r["bus_b"]] = (first, done)
    got = in_parts(stateful.PairClock(50, 10), rows, rnd)
    assert sorted(tuple(r[n] for n in ("bus_id_1", "bus_id_2", "detected_at_event_time", "distance_m",
                                       "continuous_proximity_sec")) for r in got) == sorted(want)


def _stream(spark, folder, feed, records, build):
    rows = [(None, json.dumps(r), topic_name(feed), 0, i, None) for i, r in enumerate(records)]
    spark.createDataFrame(rows, ENVELOPE).write.parquet(f"{folder}/in/{topic_name(feed)}")
    env = read_topic(spark, topic_name(feed), root=f"{folder}/in", streaming=True)
    df = build(jobs.parsed_feed(env, feed).where("error_reason IS NULL"))
    q = df.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), q


def test_state_is_kept_by_group_of_keys(spark, tmp_dir):
    """One state row a key is an exchange with the state server for each call, each in every micro-batch."""
    records = [dict(sensor_id=f"S{i % 400}", zone="Z", pm25=1.0, pm10=1.0, no2=1.0, aqi=350.0, timestamp=iso(i // 400 * 100))
               for i in range(1200)]
    out, q = _stream(spark, tmp_dir, "air_quality", records, lambda df: stateful.stream_aqi(df, groups=4, cooldown_ms=100_000))
    assert out.count() == 800 and out.where("detected_at_event_time IS NULL").isEmpty()
    states = [s for p in q.recentProgress for s in p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in states) <= 3 * 4


def test_partitions_of_packed_state(spark, monkeypatch):
    """Each costs a start of stores and Python workers in every micro-batch, and packs need few."""
    key, seen = "spark.sql.shuffle.partitions", []

    class Started:
        def awaitTermination(self):
            seen.append(int(spark.conf.get(key)))

    monkeypatch.setattr(jobs, "incidents_job", lambda *a, **k: Started())
    monkeypatch.setattr(streams._Delivery, "__init__", _with_rows(streams._Delivery.__init__, 100_000_000))
    with pytest.raises(AnalysisException):                 # nothing was written
        streams.stream_incidents(spark, "/root/testdata/sf0.001")
    assert seen == [13] * streams.SLICES


def _with_rows(init, rows):
    def there(self, *args, **kwargs):
        init(self, *args, **kwargs)
        self.rows = rows
    return there


def test_readings_below_the_threshold_move_the_watermark(spark, tmp_dir):
    records = [dict(sensor_id="S1", zone="Z", pm25=1.0, pm10=1.0, no2=1.0, aqi=a, timestamp=iso(s))
               for a, s in ((350.0, 0), (350.0, 500), (10.0, 1000))]
    out, _ = _stream(spark, tmp_dir, "air_quality", records, stateful.stream_aqi)
    assert [r.source_timestamp for r in out.orderBy("source_timestamp").collect()] == [iso(0), iso(500)]


def test_observations_do_not_multiply_with_the_rate_of_fixes(spark, tmp_dir):
    """Two buses at one fix a second: every fix sees the other bus once, not each of its fresh fixes."""
    records = [dict(bus_id=f"B{i % 2}", route_id="R1", lat=19.0, lon=72.8, speed_kmh=9.0, occupancy_pct=5,
                    timestamp=iso(i // 2)) for i in range(600)]
    records.append({**records[-1], "bus_id": "B9", "route_id": "R9", "timestamp": iso(1000)})
    out, _ = _stream(spark, tmp_dir, "bus_gps", records, stateful.pair_observations)
    assert out.count() == 599 and out.where(F.col("t") - F.col("u") > 1000).isEmpty()
