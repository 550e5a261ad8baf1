"""SET-1 / DET-4: the three alert kinds in one incident table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.schemas import (AQI_INCIDENT, BUNCHING_INCIDENT, GRIDLOCK_INCIDENT,
                                 INCIDENT_COLUMNS)


def _shape(df: DataFrame, kind: tuple[str, str]) -> DataFrame:
    cols = []
    for name, dtype in INCIDENT_COLUMNS:
        if name == "incident_type":
            cols.append(F.lit(kind[0]).alias(name))
        elif name == "severity":
            cols.append(F.lit(kind[1]).alias(name))
        elif name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def aqi_incidents(alerts: DataFrame) -> DataFrame:
    return _shape(alerts.withColumnRenamed("timestamp", "source_timestamp"), AQI_INCIDENT)


def gridlock_incidents(alerts: DataFrame) -> DataFrame:
    return _shape(alerts.withColumnRenamed("timestamp", "source_timestamp"), GRIDLOCK_INCIDENT)


def bunching_incidents(alerts: DataFrame) -> DataFrame:
    return _shape(alerts.withColumnRenamed("source_time", "source_timestamp"),
                  BUNCHING_INCIDENT)


def union_incidents(*parts: DataFrame) -> DataFrame:
    """One typed table; works on streams too (``unionByName`` with missing columns)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
