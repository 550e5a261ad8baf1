"""AGG-1 / AGG-2: event-time window aggregates shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstream.schemas import (ADVISORY_SLIDE, ADVISORY_WINDOW, UNHEALTHY_AQI, WARD_WINDOW)


def exact_sum(c: str, decimals: int | None) -> Column:
    """Sum of a column; with ``decimals`` it is summed as DECIMAL(18, decimals) so the
    result does not depend on the order rows are added in (then returned as DOUBLE)."""
    if decimals is None:
        return F.sum(c)
    return F.sum(F.col(c).cast(f"decimal(18,{decimals})")).cast("double")


def ward_energy(df: DataFrame, key: str = "ward_id", time_col: str = "event_time",
                kwh: str = "kwh_reading", pf: str = "power_factor", volt: str = "voltage",
                width: str = WARD_WINDOW, decimals: int | None = None,
                pf_decimals: int | None = None) -> DataFrame:
    """AGG-1: per key and tumbling window: total kWh, mean power factor, peak voltage.

    One hash aggregate with map-side partial aggregation, so a hot ward costs one
    partial row per task before the shuffle. Works unchanged on a watermarked stream.
    """
    if pf_decimals is None:
        avg_pf = F.avg(pf)
    else:
        avg_pf = exact_sum(pf, pf_decimals) / F.count(pf)
    return (df.groupBy(F.col(key), F.window(F.col(time_col), width).alias("window"))
              .agg(exact_sum(kwh, decimals).alias("total_kwh_consumed"),
                   avg_pf.alias("avg_power_factor"),
                   F.max(volt).alias("peak_voltage"))
              .select(key, F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      "total_kwh_consumed", "avg_power_factor", "peak_voltage"))


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(n) * mult[unit.rstrip("s")]


def rolling_average(df: DataFrame, key: str, time_col: str, value: str,
                    width: str = ADVISORY_WINDOW, slide: str = ADVISORY_SLIDE,
                    decimals: int | None = None, streaming: bool = False) -> DataFrame:
    """Mean of ``value`` per key over sliding windows (nulls ignored).

    Batch form pre-aggregates sum/count per (key, slide) and then spreads each slice to
    the ``width/slide`` windows that contain it: the shuffle carries slices, not each
    row copied once per window. Streaming form uses ``window()`` directly (the state
    store needs the plain window aggregate). Both give the same rows.
    """
    w_s, s_s = _seconds(width), _seconds(slide)
    if streaming or w_s % s_s:
        agg = (df.groupBy(F.col(key), F.window(time_col, width, slide).alias("window"))
                 .agg(exact_sum(value, decimals).alias("_sum"), F.count(value).alias("_n")))
        agg = agg.select(key, F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"), "_sum", "_n")
    else:
        n = w_s // s_s
        sl = (df.groupBy(F.col(key), F.window(time_col, slide).start.alias("_slice"))
                .agg(F.sum(F.col(value).cast(f"decimal(18,{decimals})") if decimals is not None
                           else F.col(value)).alias("_sum"),
                     F.count(value).alias("_n")))
        sl = sl.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        sl = sl.withColumn("window_start", F.col("_slice") - F.make_dt_interval(
            secs=F.col("_k") * F.lit(s_s)))
        agg = (sl.groupBy(key, "window_start")
                 .agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))
                 .withColumn("window_end", F.col("window_start") + F.make_dt_interval(
                     secs=F.lit(w_s))))
        if decimals is not None:
            agg = agg.withColumn("_sum", F.col("_sum").cast("double"))
    return agg.withColumn("rolling_avg", F.col("_sum") / F.col("_n")).drop("_sum", "_n")


def health_advisories(readings: DataFrame, profile: DataFrame, key: str = "zone",
                      time_col: str = "event_time", value: str = "aqi",
                      width: str = ADVISORY_WINDOW, slide: str = ADVISORY_SLIDE,
                      threshold: float = UNHEALTHY_AQI, decimals: int | None = None,
                      streaming: bool = False) -> DataFrame:
    """AGG-2 + JOIN-3 + FLT-3: rolling mean per zone and window, kept when above
    ``threshold``, joined (inner) with the zone profile — unknown zones vanish.

    Aggregates first and joins after (eager aggregation): equal to join-then-group as
    long as the profile key is unique, which ``unique_lookup`` enforces for tables read from
    files; repeated profile rows are dropped here.
    """
    roll = rolling_average(readings, key, time_col, value, width, slide, decimals, streaming)
    roll = roll.where(F.col("rolling_avg") > F.lit(threshold))
    attrs = [c for c in profile.columns if c != key]
    return roll.join(profile.distinct(), key, "inner").select(
        key, *attrs, "window_start", "window_end",
        F.col("rolling_avg").alias("rolling_avg_aqi"))
