"""SNK-1..5, SNK-8, SNK-9: keyed JSON message sinks.

Same key -> same partition -> per-key order. With Kafka the producer's partitioner does
this; for envelope files the rows are hash-partitioned by key and sorted by key and
event time inside each file; their offsets ascend in that order, and from one batch to the next.
Every writing query has its own folder, so equal batch numbers of two queries (or of a query with
a new checkpoint) never overwrite each other; a plain append is a writer with one batch. Batches are
entered in the log of ``sinks/commits.py``, by which readers get offsets that hold over all writers.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.schemas import ENVELOPE
from civicstream.sinks import commits
from civicstream.sources.topics import topic_path

# SNK-8: durable, at-least-once delivery (duplicates possible, handled by STR-6).
KAFKA_DELIVERY = {"kafka.acks": "all", "kafka.retries": "5", "kafka.linger.ms": "10"}


def keyed_messages(df: DataFrame, key_col: str | None, topic: str,
                   partitions: int | None = None, cols: list[str] | None = None,
                   keep_nulls: bool = False, order_col: str | None = None) -> DataFrame:
    """Envelope rows (key, value, topic, partition) for a frame. ``key_col=None`` gives
    unkeyed messages (SNK-5). ``to_json`` drops null fields unless ``keep_nulls``.
    ``order_col`` is carried along as ``_order`` for per-key ordering in files."""
    cols = cols or df.columns
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    extra = [F.col(order_col).alias("_order")] if order_col else []
    out = df.select(key.alias("key"),
                    F.to_json(F.struct(*[F.col(c) for c in cols]), opts).alias("value"),
                    F.lit(topic).alias("topic"), *extra)
    if partitions:
        out = out.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
    else:
        out = out.withColumn("partition", F.lit(None).cast("int"))
    return out


def _file_frame(msgs: DataFrame, partitions: int | None, first_offset: int = 0) -> DataFrame:
    """Place rows by their partition label, sort by (key, _order) inside each file, and number
    them in that order after all of earlier batches."""
    out = msgs.withColumn("timestamp", F.current_timestamp())
    if partitions:
        out = out.repartitionById(partitions, "partition")
    order = ["key"] + (["_order"] if "_order" in msgs.columns else [])
    out = out.sortWithinPartitions(*order)
    # consecutive within a task; without labels a task is a partition
    place = F.monotonically_increasing_id()
    place = place - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    if not partitions:
        out = out.withColumn("partition", F.spark_partition_id())
    out = out.withColumn("offset", place + F.lit(first_offset))
    return out.select("key", "value", "topic", "partition", "offset", "timestamp")


def writer_id(name: str) -> str:
    """Folder name for the output of the query with this checkpoint (or other unique name)."""
    return "w" + hashlib.sha256(name.encode()).hexdigest()[:16]


def write_keyed(df: DataFrame, key_col: str | None, topic: str, root: str | None = None,
                bootstrap: str | None = None, partitions: int | None = None,
                order_col: str | None = None, cols: list[str] | None = None,
                batch_id: int | None = None, writer: str = "batch",
                commit: bool = True) -> list[tuple[str, int, int]]:
    """Batch write of keyed JSON messages. Returns the (topic, partition, messages) written to
    files; with ``commit=False`` the caller enters them in the log, together with other outputs.

    Kafka: ``key``/``value`` rows with the delivery options. Files: envelope Parquet
    under ``root/topic``; with ``batch_id`` each micro-batch of a ``writer`` goes to its own
    folder in overwrite mode, so a retried batch replaces its own output (idempotent).
    """
    cols = cols or df.columns
    msgs = keyed_messages(df, key_col, topic, partitions, cols, order_col=order_col)
    return _write(msgs, topic, root, bootstrap, partitions, batch_id, writer, commit)


def write_raw(df: DataFrame, topic: str, root: str | None = None, bootstrap: str | None = None,
              partitions: int | None = None, order_col: str | None = None, batch_id: int | None = None,
              writer: str = "batch", commit: bool = True) -> list[tuple[str, int, int]]:
    """``write_keyed`` for messages that have their ``key`` and ``value`` already."""
    extra = [F.col(order_col).alias("_order")] if order_col else []
    part = F.pmod(F.xxhash64(F.col("key")), F.lit(partitions)).cast("int") if partitions else F.lit(None).cast("int")
    msgs = df.select("key", "value", F.lit(topic).alias("topic"), *extra, part.alias("partition"))
    return _write(msgs, topic, root, bootstrap, partitions, batch_id, writer, commit)


def _write(msgs: DataFrame, topic: str, root: str | None, bootstrap: str | None, partitions: int | None,
           batch_id: int | None, writer: str, commit: bool) -> list[tuple[str, int, int]]:
    if bootstrap:
        w = msgs.select("key", "value").write.format("kafka") \
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in KAFKA_DELIVERY.items():
            w = w.option(k, v)
        w.save()
        return []
    spark = msgs.sparkSession
    if batch_id is None:
        writer, batch_id = uuid.uuid4().hex, 0
    writer = writer_id(writer)
    if commit and commits.is_committed(spark, root, writer, batch_id):
        return []
    path = f"{topic_path(root, topic)}/writer={writer}/batch={batch_id}"
    _file_frame(msgs, partitions, batch_id << 44).write.mode("overwrite").parquet(path)
    parts = commits.counted(spark.read.schema(ENVELOPE).parquet(path), topic)
    if commit:
        commits.commit(spark, root, writer, batch_id, parts)
    return parts


def stream_keyed(df: DataFrame, key_col: str | None, topic: str, checkpoint: str,
                 root: str | None = None, bootstrap: str | None = None,
                 output_mode: str = "append", partitions: int | None = None,
                 trigger: dict | None = None, query_name: str | None = None,
                 order_col: str | None = None):
    """Streaming keyed sink with its own checkpoint (SNK-9).

    Kafka supports append and update directly. Files (in append mode, or update mode: a
    changelog of revised rows) go through ``foreachBatch`` with one idempotent folder per
    checkpoint and batch id.
    """
    cols = df.columns
    if bootstrap:
        msgs = keyed_messages(df, key_col, topic, None, cols).select("key", "value")
        w = (msgs.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                 .option("topic", topic).option("checkpointLocation", checkpoint)
                 .outputMode(output_mode))
        for k, v in KAFKA_DELIVERY.items():
            w = w.option(k, v)
    else:
        def each(batch: DataFrame, batch_id: int) -> None:
            write_keyed(batch, key_col, topic, root=root, partitions=partitions,
                        cols=cols, batch_id=batch_id, writer=checkpoint, order_col=order_col)
        w = (df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
               .outputMode(output_mode))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
