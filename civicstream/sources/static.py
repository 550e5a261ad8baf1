"""SRC-4 / SRC-5: static reference tables read from CSV with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.operators.enrich import unique_lookup
from civicstream.schemas import ROUTE_SCHEDULE, ZONE_PROFILE


def read_route_schedule(spark: SparkSession, path: str) -> DataFrame:
    """Route schedule keyed by route_id; for a duplicated key the later line wins.

    Line order comes from the file scan order (``monotonically_increasing_id`` right at
    the scan: split index then position), resolved with a grouped ``max_by``.
    """
    raw = spark.read.schema(ROUTE_SCHEDULE).option("header", "true").csv(path)
    raw = raw.withColumn("_line", F.monotonically_increasing_id())
    return unique_lookup(raw, "route_id", "_line")


def read_zone_profile(spark: SparkSession, path: str, view: str | None = "zone_profile") -> DataFrame:
    """Zone profile with a fixed schema (instead of inference), optionally registered
    as a temp view for SQL; for a duplicated zone the later line wins."""
    raw = spark.read.schema(ZONE_PROFILE).option("header", "true").csv(path)
    df = unique_lookup(raw.withColumn("_line", F.monotonically_increasing_id()), "zone", "_line")
    if view:
        df.createOrReplaceTempView(view)
    return df
