"""Scalable ordered scans for per-key sequential logic.

A key (sensor, junction, bus pair) may hold a large share of all rows, so no operator
here puts a whole key into one task or one array:

* ``prefix_scan`` computes running sums / maxima per key in event order. Rows are split
  by (key, chunk); each chunk is scanned locally by a window function, the chunk
  totals (one row per key and chunk) are scanned per key, and the carried-in value is
  joined back on (key, chunk). Work per task is bounded by the chunk, not the key.
* ``last_before`` is the backward as-of lookup (latest target before each probe within a
  horizon), by a sorted window per time bucket instead of a fan-out join.
* ``whole_groups`` gives array code many small groups of a sorted partition at once, where a
  call per group would cost more than the work in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_scan(df: DataFrame, keys: list[str], order: list[Column], chunk: str,
                specs: list[tuple[str, str, Column]], exclusive: bool = False) -> DataFrame:
    """Add running aggregates per key in ``order``.

    ``specs``: (output name, "sum" | "max" | "min", expression). ``chunk`` names a
    column that is non-decreasing along ``order`` within a key (e.g. a time bucket).
    With ``exclusive`` the current row is left out (value over strictly earlier rows).
    Sums over no rows give 0; max/min over no rows give null.
    """
    hi = -1 if exclusive else Window.currentRow
    w_local = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, hi)
    local = df.select("*", *[_AGG[kind](expr).over(w_local).alias(f"_loc_{name}")
                             for name, kind, expr in specs])
    totals = df.groupBy(*keys, chunk).agg(
        *[_AGG[kind](expr).alias(f"_tot_{name}") for name, kind, expr in specs])
    w_carry = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = totals.select(*keys, chunk, *[
        _AGG[kind](F.col(f"_tot_{name}")).over(w_carry).alias(f"_car_{name}")
        for name, kind, _ in specs])
    carry = carry.select(*[F.col(c).alias(f"_ck_{c}") for c in keys + [chunk]],
                         *[f"_car_{name}" for name, _, _ in specs])
    cond = reduce(lambda a, b: a & b,
                  [local[c].eqNullSafe(carry[f"_ck_{c}"]) for c in keys + [chunk]])
    joined = local.join(carry, cond, "left")
    outs = []
    for name, kind, _ in specs:
        loc, car = F.col(f"_loc_{name}"), F.col(f"_car_{name}")
        if kind == "sum":
            outs.append((F.coalesce(car, F.lit(0)) + F.coalesce(loc, F.lit(0))).alias(name))
        elif kind == "max":
            outs.append(F.greatest(car, loc).alias(name))
        else:
            outs.append(F.least(car, loc).alias(name))
    return joined.select(*df.columns, *outs)


def last_before(probes: DataFrame, targets: DataFrame, keys: list[str],
                horizon: int) -> DataFrame:
    """As-of lookup backwards: for each probe (keys, ``p_time``, ``p_tie``, other
    columns) the target (keys, ``t_time``, ``t_tie``, ``t_val``) with the largest
    (t_time, t_tie) below the probe's, provided t_time >= p_time - horizon. Adds
    ``t_val`` and ``t_time`` (null when there is none).

    Targets are copied into their time bucket (width ``horizon``) and the next one; a
    probe looks only in its own bucket, where a sorted window carries the latest target
    forward. Linear in probes + 2 x targets: no probe x target fan-out.
    """
    b = F.floor(F.col("t_time") / horizon).cast("long")
    val_type = targets.schema["t_val"].dataType
    extra = [c for c in probes.columns if c not in keys + ["p_time", "p_tie"]]
    tgt = targets.select(*keys, F.col("t_time").alias("_time"), F.col("t_tie").alias("_tie"),
                         F.struct(F.col("t_time").alias("t"), F.col("t_val").alias("v"))
                         .alias("_tv"), F.lit(0).alias("_is_probe"),
                         *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in extra],
                         F.explode(F.array(b, b + 1)).alias("_bucket"))
    prb = probes.select(*keys, F.col("p_time").alias("_time"), F.col("p_tie").alias("_tie"),
                        F.lit(None).cast(tgt.schema["_tv"].dataType).alias("_tv"),
                        F.lit(1).alias("_is_probe"), *extra,
                        F.floor(F.col("p_time") / horizon).cast("long").alias("_bucket"))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_time", "_tie", "_is_probe") \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = tgt.unionByName(prb).withColumn("_last", F.last("_tv", ignorenulls=True).over(w))
    hit = u.where((F.col("_is_probe") == 1)
                  & (F.col("_last.t") >= F.col("_time") - horizon))
    return hit.select(*keys, F.col("_time").alias("p_time"), F.col("_tie").alias("p_tie"),
                      *extra, F.col("_last.v").cast(val_type).alias("t_val"),
                      F.col("_last.t").alias("t_time"))


def group_starts(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Places where the values of ``keys`` change (nulls are equal), the first row included."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = rows.column(k)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def goes_on(before: pa.RecordBatch, batch: pa.RecordBatch, keys: list[str]) -> bool:
    """Whether the first row of a batch belongs to the last group of the batch before."""
    edge = pa.Table.from_batches([before.slice(before.num_rows - 1).select(keys), batch.slice(0, 1).select(keys)])
    return len(group_starts(edge.combine_chunks(), keys)) == 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups from the batches of a partition sorted by ``keys``, with the places where they
    begin. Only the last group of a batch waits for the next one."""
    held: list[pa.RecordBatch] = []

    def gathered() -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held).combine_chunks()
        return rows, group_starts(rows, keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not goes_on(held[-1], batch, keys):
            yield gathered()
            held = []
        last = int(group_starts(batch, keys)[-1])
        if last:
            held.append(batch.slice(0, last))
            yield gathered()
            held = []
        held.append(batch.slice(last))
    if held:
        yield gathered()
