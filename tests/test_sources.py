"""SRC-1 (JSON lines), SRC-2/3 (topic envelopes, multi-topic routing), STR-5 (two
independent readers of one topic), SNK-1 (keyed, per-key ordered files)."""

import json
import time

from pyspark.sql import functions as F

from civicstream.schemas import topic_name
from civicstream.sinks.keyed import write_keyed
from civicstream.sources import jsonl
from civicstream.sources.topics import decodable, read_topic, route_by_topic
from civicstream.streaming import jobs
from helpers import iso
from test_streaming import put_messages


def test_jsonl_scan_limit_and_envelope(spark, tmp_dir):
    path = f"{tmp_dir}/bus.jsonl"
    recs = [dict(bus_id=f"B{i}", route_id="R001", lat=19.0, lon=72.8, speed_kmh=1.0,
                 occupancy_pct=1, timestamp=iso(i)) for i in range(5)]
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n{broken\n")
    assert jsonl.read_jsonl(spark, path).count() == 6
    assert jsonl.read_jsonl(spark, path, limit=2).count() == 2
    env = jsonl.as_envelope(jsonl.read_jsonl(spark, path), "bus_gps")
    rows = env.collect()
    assert {r.key for r in rows} == {"R001", "unknown"}
    assert len({r.partition for r in rows if r.key == "R001"}) == 1
    tagged = jobs.parsed_feed(env, "bus_gps")
    assert tagged.where("error_reason = 'MALFORMED_JSON'").count() == 1
    s = jsonl.stream_jsonl(spark, tmp_dir, max_files_per_trigger=1)
    assert s.isStreaming


def test_lines_are_numbered_over_splits_and_files(spark, tmp_dir):
    """Small splits, several files in one task, and a stream in several batches."""
    lines = []
    for k in range(5):
        part = [f"file {k} line {i} " + "x" * (i % 50) for i in range(200 * (k % 3) + 1)]
        lines += part
        with open(f"{tmp_dir}/part-{k}.jsonl", "w") as f:
            f.write("\n".join(part) + "\n")
        time.sleep(0.05)                                  # a stream takes files by their time
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = jsonl.read_jsonl(spark, tmp_dir).collect()
        few = jsonl.read_jsonl(spark, tmp_dir, limit=7).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in sorted(got, key=lambda r: r.offset)] == lines
    assert sorted(r.offset for r in got) == list(range(len(lines)))
    assert sorted(r.value for r in few) == sorted(lines[:7])
    for run in range(2):                                  # the second run finds nothing new
        jsonl.ingest_job(jsonl.stream_jsonl(spark, f"{tmp_dir}/*.jsonl", 2), "bus_gps", f"{tmp_dir}/topics",
                         f"{tmp_dir}/ckpt", trigger={"availableNow": True}).awaitTermination()
    env = spark.read.parquet(f"{tmp_dir}/topics/{topic_name('bus_gps')}")
    assert env.select("batch").distinct().count() == 3
    assert [r.value for r in env.orderBy("offset").collect()] == lines
    assert env.agg(F.max("offset"), F.count_distinct("offset")).head() == (len(lines) - 1, len(lines))


def test_multi_topic_route_and_skip_undecodable(spark, tmp_dir):
    put_messages(spark, tmp_dir, "air_quality", [[{"sensor_id": "S1", "aqi": 1.0}, "oops"]],
                 "sensor_id")
    put_messages(spark, tmp_dir, "smart_meters", [[{"ward_id": "W1", "kwh_reading": 2.0}]],
                 "ward_id")
    env = read_topic(spark, [topic_name("air_quality"), topic_name("smart_meters")], root=tmp_dir)
    assert env.count() == 3
    assert route_by_topic(env, topic_name("smart_meters")).count() == 1
    assert decodable(env).count() == 2


def test_keyed_files_partition_by_key(spark, tmp_dir):
    df = spark.createDataFrame([(f"W{i % 3}", i) for i in range(30)], "ward_id string, n int")
    write_keyed(df, "ward_id", "t", root=tmp_dir, partitions=4, order_col="n")
    out = spark.read.parquet(f"{tmp_dir}/t").withColumn("file", F.input_file_name())
    per_key_files = out.groupBy("key").agg(F.countDistinct("file").alias("f"))
    assert per_key_files.agg(F.max("f")).collect()[0][0] == 1
    first = out.where("key = 'W0'").select("value").collect()
    ns = [json.loads(v)["n"] for (v,) in first]
    assert ns == sorted(ns)


def test_independent_readers(spark, tmp_dir):
    recs = [[{"junction_id": "J1", "avg_wait_sec": float(i)}] for i in range(4)]
    root = put_messages(spark, tmp_dir + "/in", "traffic_signals", recs, "junction_id")
    fast = read_topic(spark, topic_name("traffic_signals"), root=root, streaming=True)
    slow = read_topic(spark, topic_name("traffic_signals"), root=root, streaming=True,
                      max_per_trigger=1)
    qf, qs = jobs.independent_readers(spark, fast, slow, (tmp_dir + "/c1", tmp_dir + "/c2"),
                                      trigger={"availableNow": True})
    qf.awaitTermination()
    qs.awaitTermination()
    assert spark.table("high_priority").collect()[0][0] == 4
    assert spark.table("standard_priority").collect()[0][0] == 4
    # the slow reader needed one micro-batch per file, the fast one a single batch
    assert len([p for p in qs.recentProgress if p["numInputRows"]]) == 4
    assert len([p for p in qf.recentProgress if p["numInputRows"]]) == 1
    lag = jobs.progress_lag(qs)
    assert lag["name"] == "standard_priority"


def test_keyed_write_is_idempotent_per_batch(spark, tmp_dir):
    df = spark.createDataFrame([(f"W{i % 2}", i) for i in range(10)], "ward_id string, n int")
    for _ in range(2):  # a retried micro-batch writes batch 7 again
        write_keyed(df, "ward_id", "t", root=tmp_dir, partitions=2, batch_id=7)
    write_keyed(df.limit(3), "ward_id", "t", root=tmp_dir, partitions=2, batch_id=8)
    out = spark.read.parquet(f"{tmp_dir}/t")
    assert out.where("batch = 7").count() == 10
    assert out.count() == 13


def test_lines_stay_where_they_are_read_when_numbered(spark, tmp_dir):
    """Nothing is known of a stream's size, so the counts of splits are not broadcast unasked."""
    with open(f"{tmp_dir}/a.jsonl", "w") as f:
        f.write("{}\n" * 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jsonl.read_jsonl(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
