"""OPS-1..5, AGG-6/7, STR-6 (batch): operational report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicstream.schemas import LATEST_PER_TOPIC, TOPICS, topic_name


def latest_per_topic(env: DataFrame, n: int = LATEST_PER_TOPIC, topic: str = "topic",
                     order: list | None = None) -> DataFrame:
    """OPS-1 / TOPK-1: newest ``n`` records per topic.

    ``row_number() <= n`` lets Spark insert a per-partition group limit before the
    shuffle, so each task ships at most ``n`` rows per topic even for a hot topic.
    """
    order = order or [F.col("timestamp").desc(), F.col("partition").asc(),
                      F.col("offset").desc()]
    w = Window.partitionBy(topic).orderBy(*order)
    return env.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def key_totals(summary: DataFrame, key: str = "ward_id",
               value: str = "total_kwh_consumed", out: str = "total_kwh") -> DataFrame:
    """AGG-6: total of a windowed measure per key, largest first."""
    return summary.groupBy(key).agg(F.sum(value).alias(out)).orderBy(F.desc(out), key)


def topic_catalog(spark: SparkSession) -> DataFrame:
    """SRC-6: topic, partitions, retention (ms), key field."""
    return spark.createDataFrame(
        [(topic_name(t), p, r, k) for t, p, r, k in TOPICS],
        "topic string, partitions int, retention_ms long, key_field string")


def within_retention(env: DataFrame, catalog: DataFrame, topic: str = "topic",
                     time_col: str = "timestamp") -> DataFrame:
    """OPS-4: records still inside their topic's retention, measured back from the newest record
    of the topic. The bounds (one per catalog topic) are found first, from the topic and time
    columns alone, and become literals, so they are pushed into the scan of each topic's records:
    row groups that are older are not read."""
    newest = env.groupBy(topic).agg(F.max(time_col).alias("_newest"))
    kept = catalog.select(topic, "retention_ms")
    bounds = newest.join(kept, topic).select(topic, (F.col("_newest") - F.make_dt_interval(
        secs=(F.col("retention_ms") / F.lit(1000)).cast("decimal(18,6)"))).alias("_from")).collect()
    inside = F.lit(False)
    for b in bounds:
        inside = inside | ((F.col(topic) == b[0]) & (F.col(time_col) >= F.lit(b[1]).cast(env.schema[time_col].dataType)))
    return env.where(inside)


def consumer_lag(committed: DataFrame, end_offsets: DataFrame) -> DataFrame:
    """OPS-2: per consumer group, sum over partitions of (end - committed).

    ``committed``: group, topic, partition, committed (next offset to read).
    ``end_offsets``: topic, partition, end (next offset to be written). A group whose
    committed table has no rows has lag null (as the CLI shows nothing for it).
    """
    j = committed.join(end_offsets, ["topic", "partition"], "left")
    return j.groupBy("group").agg(
        F.sum(F.greatest(F.col("end") - F.col("committed"), F.lit(0))).alias("lag"))


def end_offsets(env: DataFrame) -> DataFrame:
    """End offset per (topic, partition) = highest offset + 1 (a partial aggregate)."""
    return env.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))


def committed_through(read: DataFrame, group: str) -> DataFrame:
    """Committed offsets of a group that has read the records in ``read``: per
    (topic, partition), one past the highest offset read."""
    return read.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("committed")).withColumn("group", F.lit(group))


def unread_records(env: DataFrame, committed: DataFrame) -> DataFrame:
    """OPS-2 for envelopes whose offsets are not dense: lag = records at or past the
    group's committed offset, summed over partitions. ``committed`` has one row per
    (group, topic, partition), bounded by the topic catalog, so it is broadcast."""
    j = env.join(F.broadcast(committed), ["topic", "partition"])
    return j.groupBy("group").agg(
        F.count_if(F.col("offset") >= F.col("committed")).cast("long").alias("lag"))


def lag_series(env: DataFrame, progress: list[tuple]) -> DataFrame:
    """OPS-3: lag of each group at each sample.

    ``progress``: (sample, group, sample_time, read_until) rows — the samples are a
    parameter, not data. Lag at a sample = records written by then and not yet read
    (read_until < timestamp <= sample_time). One pass over the records with one
    conditional count per progress row (partial aggregation), unpivoted with ``stack``.
    """
    counts = [F.count_if((F.col("timestamp") > F.lit(ru)) & (F.col("timestamp") <= F.lit(st)))
              .alias(f"_lag{i}") for i, (_, _, st, ru) in enumerate(progress)]
    wide = env.agg(*counts)
    pairs = ", ".join(f"CAST({int(smp)} AS BIGINT), '{grp}', _lag{i}"
                      for i, (smp, grp, _, _) in enumerate(progress))
    return wide.selectExpr(f"stack({len(progress)}, {pairs}) AS (sample, `group`, lag)")


def per_label_counts(df: DataFrame, label: str = "consumer") -> DataFrame:
    """AGG-7: records processed per consumer label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("processed"))


def dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """STR-6 batch form: drop replayed duplicates on the given keys (opt-in)."""
    return df.dropDuplicates(keys)
