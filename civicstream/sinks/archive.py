"""SNK-6: Parquet archive partitioned by key and calendar date (append)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.functions.timecols import window_date


def with_date(df: DataFrame, start_col: str = "window_start") -> DataFrame:
    """PRJ-12: the ``date`` partition column (UTC session time zone)."""
    return df.withColumn("date", window_date(start_col))


def write_archive(df: DataFrame, path: str, partition_cols=("ward_id", "date"),
                  mode: str = "append") -> None:
    """Batch append into the partitioned archive. Readers filtering on ``ward_id`` or
    ``date`` get partition pruning (``PartitionFilters`` in the scan)."""
    with_date(df).write.mode(mode).partitionBy(*partition_cols).parquet(path)


def stream_archive(df: DataFrame, path: str, checkpoint: str,
                   partition_cols=("ward_id", "date"), trigger: dict | None = None,
                   query_name: str | None = None):
    """Streaming append into the partitioned archive (file sink, exactly-once via its
    own commit log); each row lands once, when its window closes."""
    w = (with_date(df).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy(*partition_cols)
         .outputMode("append"))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_archive(spark, path: str, ward: str | None = None, day: str | None = None) -> DataFrame:
    """Read the archive with optional partition filters (pruned at planning time)."""
    df = spark.read.parquet(path)
    if ward is not None:
        df = df.where(F.col("ward_id") == F.lit(ward))
    if day is not None:
        df = df.where(F.col("date") == F.lit(day).cast("date"))
    return df
