"""SRC-1: JSON-lines scan, one record per line, raw text kept for the dead-letter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicstream.schemas import ENVELOPE, KEY_FIELD, TOPICS, topic_name
from civicstream.sources.topics import topic_path


def placed_lines(lines: DataFrame) -> DataFrame:
    """The lines with the file and the split they come from (of a batch or a stream)."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"))


def numbered_lines(placed: DataFrame, first: int = 0) -> DataFrame:
    """``value``, ``file``, and ``offset``: the number of the line in the whole input, files in
    order of their path. A line is its place in its split, plus the lines of the splits before it:
    a prefix sum over one row per split, which is broadcast, so no line is moved to be numbered."""
    placed = placed.withColumn("_id", F.monotonically_increasing_id())
    splits = placed.groupBy("file", "block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "_first",
                           (F.coalesce(before, F.lit(0)) + first).alias("_before"))
    return placed.join(F.broadcast(splits), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))).select(
        "value", "file", (F.col("_id") - F.col("_first") + F.col("_before")).alias("offset"))


def read_jsonl(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Batch scan: a ``value`` column holding each line, its ``file`` and its number (``offset``).
    ``limit`` keeps the first n lines (the source's optional row limit)."""
    lines = numbered_lines(placed_lines(spark.read.text(path)))
    return lines.where(F.col("offset") < limit) if limit else lines


def stream_jsonl(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder of JSON-lines files: ``placed_lines``. Pacing of the source (a
    sleep between records) becomes ``maxFilesPerTrigger``. ``ingest_job`` numbers the lines."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return placed_lines(r.load(path))


def ingest_job(placed: DataFrame, feed: str, root: str, checkpoint: str, trigger: dict | None = None,
               name: str | None = None) -> StreamingQuery:
    """A stream of JSON-lines files as a topic of envelope files. Lines are numbered on from those of
    the batches before, whose last numbers stand in the topic itself: a batch that is run again
    counts only the folders of earlier ones and so gives its lines the same offsets."""
    spark = placed.sparkSession
    topic = topic_path(root, topic_name(feed))

    def each(batch: DataFrame, batch_id: int) -> None:
        first = 0
        if batch_id:
            past = [f"{topic}/batch={i}" for i in range(batch_id)]
            newest = spark.read.schema(ENVELOPE).parquet(*past).agg(F.max("offset")).head()[0]
            first = 0 if newest is None else newest + 1
        as_envelope(numbered_lines(batch, first), feed).write.mode("overwrite").parquet(f"{topic}/batch={batch_id}")

    w = placed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def as_envelope(lines: DataFrame, feed: str) -> DataFrame:
    """Give raw lines the message envelope: key from the feed's key field (PRJ-8
    default ``unknown``), topic, partition from the key hash, event time as timestamp, and the
    number of the line as offset."""
    parts = {t: p for t, p, _, _ in TOPICS}[feed]
    key = F.get_json_object("value", f"$.{KEY_FIELD[feed]}")
    return lines.select(
        F.coalesce(key, F.lit("unknown")).alias("key"), F.col("value"),
        F.lit(topic_name(feed)).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("partition"),
        "offset",
        F.get_json_object("value", "$.timestamp").try_cast("timestamp").alias("timestamp"))
