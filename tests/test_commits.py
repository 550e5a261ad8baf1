"""The log of commits: offsets over all writers, batches seen whole or not at all, late rows kept."""

import json
import threading

import pytest
from helpers import iso
from test_streaming import put_messages
from pyspark.sql import functions as F

from civicstream.schemas import topic_name
from civicstream.sinks import commits
from civicstream.sinks.keyed import write_keyed, writer_id
from civicstream.sources.topics import read_topic
from civicstream.streaming import jobs

ONCE = {"availableNow": True}


def keyed(spark, numbers):
    return spark.createDataFrame([(f"K{i % 5}", i) for i in numbers], "k string, n int")


def offsets(spark, root):
    log = commits.read_committed(spark, root, "t")
    return {p: sorted(x.offset for x in log.where(F.col("partition") == p).collect())
            for p in [r.partition for r in log.select("partition").distinct().collect()]}


@pytest.mark.parametrize("partitions", [3, None])
def test_offsets_are_dense_over_writers_batches_and_appends(spark, tmp_dir, partitions):
    for b in range(2):
        for writer in ("x", "y"):
            write_keyed(keyed(spark, range(10 * b, 10 * b + 10)), "k", "t", root=tmp_dir, partitions=partitions,
                        batch_id=b, writer=writer, order_col="n")
    for _ in range(2):
        write_keyed(keyed(spark, range(7)), "k", "t", root=tmp_dir, partitions=partitions)
    got = offsets(spark, tmp_dir)
    assert sum(map(len, got.values())) == 54
    assert all(v == list(range(len(v))) for v in got.values())
    if partitions:
        rows = commits.read_committed(spark, tmp_dir, "t").where("key = 'K1' and entry in (0, 2)").orderBy("offset")
        assert [json.loads(r.value)["n"] for r in rows.collect()] == [1, 6, 11, 16]


def test_writers_at_the_same_time_take_different_numbers(spark, tmp_dir):
    got = []
    threads = [threading.Thread(target=lambda i=i: got.append(commits.commit(spark, tmp_dir, f"w{i}", 0, [("t", 0, i)])))
               for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(8))
    assert commits.entries(spark, tmp_dir).agg(F.sum("messages")).head()[0] == sum(range(8))


def test_files_without_an_entry_are_not_read_and_a_committed_batch_is_not_written_again(spark, tmp_dir):
    write_keyed(keyed(spark, range(4)), "k", "t", root=tmp_dir, partitions=2, batch_id=0)
    parts = write_keyed(keyed(spark, range(4, 9)), "k", "t", root=tmp_dir, partitions=2, batch_id=1, commit=False)
    assert sum(n for _, _, n in parts) == 5
    assert commits.read_committed(spark, tmp_dir, "t").count() == 4
    write_keyed(keyed(spark, range(4, 9)), "k", "t", root=tmp_dir, partitions=2, batch_id=1)
    write_keyed(keyed(spark, range(99)), "k", "t", root=tmp_dir, partitions=2, batch_id=1)
    assert commits.read_committed(spark, tmp_dir, "t").count() == 9
    assert commits.is_committed(spark, tmp_dir, writer_id("batch"), 1)
    assert not commits.is_committed(spark, tmp_dir, writer_id("other"), 1)


def air(second, **more):
    return dict(sensor_id="S1", zone="Z", pm25=1.0, pm10=1.0, no2=1.0, aqi=2.0, timestamp=iso(second), **more)


def test_late_rows_go_to_the_dlq_with_their_text(spark, tmp_dir):
    batches = [[air(0), air(7200)], [air(7200 - 2700), air(7200 - 2701), "no json", air(9000)], [air(9000 - 2701)]]
    root = put_messages(spark, f"{tmp_dir}/in", "air_quality", batches, "sensor_id")
    env = read_topic(spark, topic_name("air_quality"), root=root, streaming=True, max_per_trigger=1)
    jobs.lateness_job(env, "air_quality", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", trigger=ONCE).awaitTermination()
    kept = commits.read_committed(spark, f"{tmp_dir}/out", topic_name("air_quality")).collect()
    dead = [json.loads(r.value) for r in commits.read_committed(spark, f"{tmp_dir}/out", topic_name("dlq")).collect()]
    assert len(kept) == 5 and sum(r.value == "no json" for r in kept) == 1
    assert sorted(json.loads(d["original_record"])["timestamp"] for d in dead) == [iso(7200 - 2701), iso(9000 - 2701)]
    assert {d["error_reason"] for d in dead} == {"LATE_EVENT"}


def test_both_halves_of_a_batch_are_seen_together(spark, tmp_dir):
    rows = spark.createDataFrame([("W1", 1)], "ward_id string, n int")
    for b in range(2):
        parts = write_keyed(rows, "ward_id", "t", root=tmp_dir, partitions=2, batch_id=b, commit=False)
        rows.withColumn("batch", F.lit(b)).write.mode("append").partitionBy("ward_id", "batch").parquet(f"{tmp_dir}/arc")
        if b == 0:
            commits.commit(spark, tmp_dir, writer_id("batch"), b, [*parts, ("archive", None, 1)])
    assert commits.read_committed(spark, tmp_dir, "t").count() == 1
    out = commits.committed_archive(spark, tmp_dir, f"{tmp_dir}/arc", "archive")
    assert out.count() == 1 and "batch" not in out.columns
