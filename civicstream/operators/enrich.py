"""JOIN-1..3, PRJ-5/6: enrich a stream from a static lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only below this many rows and bytes (checked by counting the static
# table, which is cheap for a reference table); above them the join shuffles.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def unique_lookup(lookup: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """SRC-4: one row per key; a later duplicate overwrites an earlier one.

    ``order_col`` gives "later" (e.g. line number); without it rows are assumed unique.
    A grouped ``max_by`` (partial aggregation) — no per-key collection.
    """
    if order_col is None:
        return lookup
    rest = [c for c in lookup.columns if c not in (key, order_col)]
    return (lookup.groupBy(key)
                  .agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_r"))
                  .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def sized_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a static lookup only after checking its rows and bytes (the length of its
    rows as JSON, so wide rows count as such); otherwise return it unchanged and let the
    planner (and AQE, from measured sizes) pick the join."""
    n, size = lookup.limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(lookup) if n <= max_rows and size <= max_bytes else lookup


def route_key(df: DataFrame, key_col: str = "key", payload_col: str = "route_id",
              out: str = "route_key") -> DataFrame:
    """PRJ-6: message key, else the payload field."""
    return df.withColumn(out, F.coalesce(F.col(key_col), F.col(payload_col)))


def enrich_eta(gps: DataFrame, routes: DataFrame, key: str = "route_key",
               broadcast_checked: bool = True) -> DataFrame:
    """JOIN-1 + PRJ-5: inner join of GPS fixes with the route schedule; fixes whose route
    is unknown are skipped. Output renames ``timestamp`` to ``gps_timestamp``."""
    lk = sized_broadcast(routes) if broadcast_checked else routes
    lk = lk.withColumnRenamed("route_id", key)
    j = gps.join(lk, key, "inner")
    return j.select("bus_id", F.col(key).alias("route_id"), "lat", "lon", "speed_kmh",
                    "occupancy_pct", F.col("timestamp").alias("gps_timestamp"),
                    "route_name", "terminal", "scheduled_arrival_time")


def enrich_misses(gps: DataFrame, routes: DataFrame, key: str = "route_key") -> DataFrame:
    """JOIN-2: fixes whose route is not in the lookup."""
    lk = sized_broadcast(routes.select(F.col("route_id").alias(key)))
    return gps.join(lk, key, "left_anti")


def enrich_counters(gps: DataFrame, routes: DataFrame, key: str = "route_key",
                    key_col: str = "key") -> DataFrame:
    """JOIN-2 / OPS-5: joined, unmatched and missing-key counts in one left join."""
    lk = sized_broadcast(routes.select(F.col("route_id").alias(key),
                                       F.lit(True).alias("_hit")))
    j = gps.join(lk, key, "left")
    return j.agg(F.count_if(F.col("_hit").isNotNull()).alias("joined"),
                 F.count_if(F.col("_hit").isNull()).alias("unmatched"),
                 F.count_if(F.col(key_col).isNull()).alias("missing_key"))
