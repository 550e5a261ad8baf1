"""AGG-3..5 and VAL-8: dead-letter distribution reports as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicstream.functions.jsoncols import default_label
from civicstream.schemas import DLQ_REPORT_WINDOW, REASONS, topic_name

# Rule descriptions (ours) for the catalog, in evaluation order per feed.
RULE_DESCRIPTIONS = {
    "NULL_COORDINATES": "latitude or longitude missing",
    "IMPOSSIBLE_GPS_COORDINATES": "latitude outside [-90, 90] or longitude outside [-180, 180]",
    "SPEED_OUT_OF_RANGE": "speed missing or outside [0, 120] km/h",
    "OCCUPANCY_OUT_OF_RANGE": "occupancy missing or outside [0, 100] %",
    "MISSING_ID_FIELD": "an identifier field is missing or empty",
    "NULL_AQI": "AQI reading missing",
    "AQI_OUT_OF_RANGE": "AQI outside [0, 500]",
    "NEGATIVE_OR_MISSING_PM25": "PM2.5 missing or negative",
    "NEGATIVE_OR_MISSING_PM10": "PM10 missing or negative",
    "NEGATIVE_OR_MISSING_NO2": "NO2 missing or negative",
    "NEGATIVE_VEHICLE_COUNT": "vehicle count missing or negative",
    "WAIT_TIME_OUT_OF_RANGE": "average wait missing or outside [0, 600] s",
    "INVALID_SIGNAL_PHASE": "signal phase not GREEN, RED or AMBER",
    "NEGATIVE_KWH_READING": "energy reading missing or negative",
    "VOLTAGE_OUT_OF_RANGE": "voltage missing or outside [180, 260] V",
    "POWER_FACTOR_OUT_OF_RANGE": "power factor missing or outside [0, 1]",
}


def rule_catalog(spark: SparkSession) -> DataFrame:
    """All (topic, rule order, reason, description) rows; 19 rules over four feeds."""
    rows = [(topic_name(feed), i + 1, r, RULE_DESCRIPTIONS[r])
            for feed, reasons in REASONS.items() for i, r in enumerate(reasons)]
    return spark.createDataFrame(
        rows, "source_topic string, rule_order int, error_reason string, description string")


def by_reason(dlq: DataFrame) -> DataFrame:
    """AGG-3: count and percent of total per reason, largest first.

    The percent window runs over the aggregated rows (one per reason), never over data.
    """
    counts = dlq.groupBy(default_label("error_reason").alias("error_reason")) \
                .agg(F.count(F.lit(1)).alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    return counts.select("error_reason", "cnt",
                         (F.lit(100.0) * F.col("cnt") / total).alias("pct")) \
                 .orderBy(F.desc("cnt"), "error_reason")


def by_topic(dlq: DataFrame) -> DataFrame:
    """AGG-4: count per (source topic, reason), largest first within a topic."""
    return (dlq.groupBy(default_label("source_topic").alias("source_topic"),
                        default_label("error_reason").alias("error_reason"))
               .agg(F.count(F.lit(1)).alias("cnt"))
               .orderBy("source_topic", F.desc("cnt"), "error_reason"))


def by_window(dlq: DataFrame, time_col: str = "timestamp",
              width: str = DLQ_REPORT_WINDOW) -> DataFrame:
    """AGG-5: counts per report window (deterministic event-time window) and reason."""
    return (dlq.groupBy(F.window(time_col, width).alias("w"),
                        default_label("source_topic").alias("source_topic"),
                        default_label("error_reason").alias("error_reason"))
               .agg(F.count(F.lit(1)).alias("cnt"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "source_topic", "error_reason", "cnt"))


def catalog_hits(catalog: DataFrame, dlq: DataFrame) -> DataFrame:
    """VAL-8: every rule with its hit count (0 for rules that never fired)."""
    hits = dlq.groupBy("source_topic", "error_reason").agg(F.count(F.lit(1)).alias("hits"))
    return (catalog.join(hits, ["source_topic", "error_reason"], "left")
                   .select("source_topic", "rule_order", "error_reason", "description",
                           F.coalesce("hits", F.lit(0)).cast("long").alias("hits")))
