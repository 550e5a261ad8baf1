"""PRJ-1 / PRJ-4 / PRJ-7 / PRJ-8: JSON message values <-> typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstream.functions.timecols import event_time


def parse_value(msgs: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: tuple[str, ...] = ("key", "topic", "partition", "offset", "timestamp"),
                keep_raw: bool = False) -> DataFrame:
    """Parse a JSON value into typed columns (``rec.*``), add ``event_time`` from the
    payload's ISO ``timestamp`` and a ``_malformed`` flag for text that is not a JSON
    object (those rows are kept, all fields null, for the dead-letter table).

    Envelope columns in ``keep`` are carried with an ``env_`` prefix when they clash
    with payload fields.
    """
    payload = set(schema.fieldNames())
    carry = []
    for c in keep:
        if c in msgs.columns:
            carry.append(F.col(c).alias(f"env_{c}" if c in payload else c))
    if keep_raw:
        carry.append(F.col(value_col))
    rec = F.from_json(F.col(value_col), schema)
    probe = F.from_json(F.col(value_col), T.MapType(T.StringType(), T.StringType()))
    out = msgs.select(*carry, rec.alias("_rec"), probe.isNull().alias("_malformed"))
    out = out.select(*[c for c in out.columns if c not in ("_rec",)], "_rec.*")
    if "timestamp" in payload:
        out = out.withColumn("event_time", event_time("timestamp"))
    return out


def to_value(df: DataFrame, key_col: str | None, cols: list[str] | None = None,
             keep_nulls: bool = False) -> DataFrame:
    """PRJ-4: ``key`` + ``to_json(struct(*))`` value. ``to_json`` drops null fields
    unless ``keep_nulls`` (``ignoreNullFields=false``)."""
    cols = cols or df.columns
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    key: Column = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in cols]), opts).alias("value"))


def default_label(c: str, label: str = "UNKNOWN") -> Column:
    """PRJ-7: a missing field shown as ``UNKNOWN``."""
    return F.coalesce(F.col(c), F.lit(label))


def default_key(c: str) -> Column:
    """PRJ-8: a missing message key becomes ``unknown``."""
    return F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
