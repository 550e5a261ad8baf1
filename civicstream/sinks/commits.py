"""SNK-1, SNK-7: the log of committed batches of the topics and archives under one folder.

A batch writes its files first, then one entry of the log. Entries are JSON files named by
number under ``root/_commits``; a number is taken by a rename that fails if the name exists, so two
writers never share one, and an entry is seen whole or not at all. That needs a file system with
atomic renames, as HDFS has; a local one checks and renames in two steps, so the queries of one
driver also take turns. It names every output of the
batch: readers that go by the log see both halves of a dual sink, or neither. A batch that is run
again after its entry was written finds it there and is left out.

An entry also counts the batch's messages by topic and partition. The offset of a message is the
number of messages that earlier entries hold in its topic and partition, whoever wrote them, plus
its place in its own batch. It is computed on reading, from one row per batch and partition.
"""

from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TURN = threading.Lock()

ENTRY = "number long, writer string, batch long, sink string, partition int, messages long, newest long"


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def entries(spark: SparkSession, root: str) -> DataFrame:
    """One row per sink and partition of every committed batch."""
    fs, path = _files(spark, log_path(root))
    if not fs.exists(path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(log_path(root))


def is_committed(spark: SparkSession, root: str, writer: str, batch: int) -> bool:
    mine = entries(spark, root).where((F.col("writer") == writer) & (F.col("batch") == batch))
    return not mine.limit(1).isEmpty()


def newest_before(spark: SparkSession, root: str, writer: str, batch: int):
    """The latest event time (microseconds) in the writer's batches before this one, or None."""
    mine = entries(spark, root).where((F.col("writer") == writer) & (F.col("batch") < batch))
    return mine.agg(F.max("newest")).head()[0]


def counted(segment: DataFrame, sink: str) -> list[tuple[str, int, int]]:
    """(sink, partition, messages) of written files; one row per partition of the topic."""
    return [(sink, r.partition, r.n) for r in segment.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).collect()]


def commit(spark: SparkSession, root: str, writer: str, batch: int, parts: list[tuple[str, int | None, int]],
           newest: int | None = None) -> int:
    """Write the entry of a batch whose files are all there, and return its number."""
    jvm = spark._jvm
    fs, folder = _files(spark, log_path(root))
    fs.mkdirs(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf) \
        if folder.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    never_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    new_path = jvm.org.apache.hadoop.fs.Path
    with _TURN:
        while True:
            taken = [int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(folder)
                     if f.getPath().getName().endswith(".json") and not f.getPath().getName().startswith((".", "_"))]
            number = max(taken, default=-1) + 1
            lines = [json.dumps({"number": number, "writer": writer, "batch": batch, "sink": s, "partition": p,
                                 "messages": n, "newest": newest})
                     for s, p, n in parts or [(None, None, 0)]]
            draft = new_path(folder, f".{uuid.uuid4().hex}.draft")
            out = fs.create(draft, False)
            out.write(bytearray("".join(x + "\n" for x in lines).encode()))
            out.close()
            try:
                context.rename(context.makeQualified(draft), context.makeQualified(new_path(folder, f"{number:020d}.json")),
                               never_overwrite)
                return number
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                    raise
                fs.delete(draft, False)


def read_committed(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The messages of committed batches, with their offsets, and ``entry`` (number of the commit)."""
    earlier = Window.partitionBy("partition").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    base = entries(spark, root).where(F.col("sink") == topic).select(
        F.col("number").alias("entry"), F.col("writer").alias("_w"), F.col("batch").alias("_b"),
        F.col("partition").alias("_p"), F.coalesce(F.sum("messages").over(earlier), F.lit(0)).alias("_base"))
    msgs = spark.read.parquet(f"{root.rstrip('/')}/{topic}").withColumn("writer", F.col("writer").cast("string"))
    return msgs.join(base, (F.col("writer") == F.col("_w")) & (F.col("batch") == F.col("_b"))
                     & (F.col("partition") == F.col("_p"))).select(
        "key", "value", "topic", "partition",
        (F.col("offset") - F.shiftleft(F.col("batch").cast("long"), 44) + F.col("_base")).alias("offset"),
        "timestamp", "entry")


def committed_archive(spark: SparkSession, root: str, path: str, sink: str) -> DataFrame:
    """The rows of an archive with a ``batch`` level, of committed batches only, without that level."""
    done = entries(spark, root).where(F.col("sink") == sink).select(F.col("batch").alias("_b")).distinct()
    return spark.read.parquet(path).join(done, F.col("batch") == F.col("_b"), "left_semi").drop("batch")
