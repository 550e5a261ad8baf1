"""DET-1..3 in batch: the three keyed detectors as distributed DataFrame jobs.

Order is (event time, tie-breaker, hash of the row): the tie-breaker (an offset or record id) may be
null or repeated; a null one comes first, and rows that are equal in everything are interchangeable.
Rows without an event time take no part. No key is gathered into one task: its rows are cut into
chunks of event time (``chunk_ms``, a day unless told otherwise; choose it so that a chunk of the
busiest key fits a task), each chunk is reduced to what it does to the state that enters it, and
only these reductions are put together per key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicstream.functions.geo import haversine_m, pair_key, unit_sphere_cells
from civicstream.functions.timecols import epoch_ms
from civicstream.operators.scan import goes_on, group_starts, last_before, prefix_scan, whole_groups
from civicstream.schemas import (AQI_COOLDOWN_MS, AQI_HAZARDOUS, BUNCHING_DISTANCE_M,
                                 BUNCHING_DURATION_MS, BUNCHING_FRESH_MS, GRIDLOCK_CYCLES,
                                 GRIDLOCK_WAIT_SEC)

DAY_MS = 86_400_000
NO_TIE = -(2**63)  # a null tie-breaker comes before all others
NONE_FIRED = -(2**62)  # time of the last firing before the first one


def _ordered(df: DataFrame, time_col: str, tie_col: str, chunk_ms: int | None) -> DataFrame:
    """Order columns ``_t`` (epoch ms), ``_tie``, ``_row`` and a time chunk ``_chunk`` of the rows
    that have an event time."""
    t = epoch_ms(time_col)
    tie = F.coalesce(F.col(tie_col).cast("long"), F.lit(NO_TIE))
    return df.where(t.isNotNull()).select(
        "*", t.alias("_t"), tie.alias("_tie"), F.xxhash64(*df.columns).alias("_row"),
        F.floor(t / (chunk_ms or DAY_MS)).cast("long").alias("_chunk"))


def _order() -> list[Column]:
    return [F.col("_t"), F.col("_tie"), F.col("_row")]


def _next_firing(at: np.ndarray, cooldown_ms: int) -> np.ndarray:
    """For ascending times: the place of the first one a cooldown later (their number if none)."""
    return np.maximum(np.searchsorted(at, at + cooldown_ms), np.arange(1, len(at) + 1))


def cooldown_alerts(df: DataFrame, key: str, time_col: str, value_col: str, tie_col: str,
                    threshold: float = AQI_HAZARDOUS, cooldown_ms: int = AQI_COOLDOWN_MS,
                    chunk_ms: int | None = None) -> DataFrame:
    """DET-1: rows with ``value > threshold`` that raise an alert when the previous
    *emitted* alert of the key is absent or at least ``cooldown_ms`` older (a greedy
    chain: suppressed rows do not move the clock).

    A chunk is a function from the last firing before it to the last firing in it. Which row
    fires first in the chunk depends on the entering time only within one cooldown of the chunk's
    start, so the function is a short list of steps: entering times up to ``upto`` lead to ``out``.
    1. each (key, chunk) is reduced to its function;
    2. the functions of a key are applied one after another, giving each chunk its entering time;
    3. each (key, chunk) follows its chain from there.
    Spark deals out and sorts the rows of each step, and array code handles all groups of a batch
    together: their times are laid one group after another on one axis, more than a cooldown apart.
    Returns the firing rows with ``detected_at_event_time`` (epoch ms).
    """
    cand = _ordered(df.where(F.col(value_col) > F.lit(threshold)), time_col, tie_col, chunk_ms)
    kind = df.schema[key].dataType.simpleString()
    width = chunk_ms or DAY_MS
    apart = width + cooldown_ms + 2              # a chunk has the places 1..width of its stretch

    def spread(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number and end of the group of each of the rows."""
        sizes = np.diff(np.append(starts, n))
        return np.repeat(np.arange(len(starts)), sizes), np.repeat(starts + sizes, sizes)

    def as_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, ["_k", "_chunk"]):
            t = rows.column("_t").to_numpy()
            base = rows.column("_chunk").to_numpy() * width
            group, _ = spread(starts, len(t))
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (group[1:] != group[:-1])
            t, base, group = t[new], base[new], group[new]
            first = np.searchsorted(group, np.arange(len(starts)))
            _, end = spread(first, len(t))
            nxt = _next_firing(group * apart + (t - base + 1), cooldown_ms)
            last = np.where(nxt < end, nxt, np.arange(len(t)))   # end of the chain that begins at each time
            while not np.array_equal(on := last[last], last):
                last = on
            # times within a cooldown of the chunk's start, and the first one after them
            told = np.append(True, t[:-1] - base[:-1] < cooldown_ms)
            told[first] = True
            upto, out, group = t[told] - cooldown_ms, t[last[told]], group[told]
            step = np.append((out[1:] != out[:-1]) | (group[1:] != group[:-1]), True)  # steps to the same firing are one
            edges = pa.array(np.searchsorted(group[step], np.arange(len(starts) + 1)), pa.int32())
            of = rows.take(pa.array(starts))
            yield from pa.table({"_k": of.column("_k"), "_chunk": of.column("_chunk"),
                                 "_upto": pa.ListArray.from_arrays(edges, pa.array(upto[step])),
                                 "_out": pa.ListArray.from_arrays(edges, pa.array(out[step]))}).to_batches()

    def entering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, NONE_FIRED
        for batch in batches:
            if not batch.num_rows:
                continue
            new = set(group_starts(batch, ["_k"]).tolist())
            if before is not None and goes_on(before, batch, ["_k"]):
                new.discard(0)
            upto, out = (batch.column(c).flatten().to_pylist() for c in ("_upto", "_out"))
            ends = np.cumsum(batch.column("_upto").value_lengths().to_numpy()).tolist()
            enters, start = [], 0
            for i, end in enumerate(ends):
                if i in new:
                    last = NONE_FIRED
                enters.append(last)
                step = bisect_left(upto, last, start, end)
                if step < end:
                    last = out[step]
                start = end
            before = batch
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k"), batch.column("_chunk"), pa.array(enters, pa.int64())], ["_k", "_chunk", "_enters"])

    def firing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, [key, "_chunk"]):
            # the first row of a group brings its entering time, at place 0 of its stretch
            base = rows.column("_chunk").to_numpy() * width
            group, ends = spread(starts, rows.num_rows)
            place = group * apart + (rows.column("_t").to_numpy() - base + 1)
            nxt, end = _next_firing(place, cooldown_ms), ends[starts]
            enters = rows.column("_enters").take(pa.array(starts)).to_numpy()
            opens = np.clip(enters + cooldown_ms - base[starts] + 1, 1, apart - 1)
            at = np.searchsorted(place, np.arange(len(starts)) * apart + opens)
            fired = []
            while len(on := np.flatnonzero(at < end)):
                at, end = at[on], end[on]
                fired.append(at)
                at = nxt[at]
            if fired:
                yield from rows.drop_columns("_enters").take(pa.array(np.sort(np.concatenate(fired)))).to_batches()

    def sorted_groups(rows: DataFrame, dealt: list[str], *order: str) -> DataFrame:
        return rows.repartition(*dealt).sortWithinPartitions(*dealt, *order)

    functions = sorted_groups(cand.select(F.col(key).alias("_k"), "_chunk", "_t"), ["_k", "_chunk"], "_t").mapInArrow(
        as_functions, f"_k {kind}, _chunk long, _upto array<long>, _out array<long>")
    enters = sorted_groups(functions, ["_k"], "_chunk").mapInArrow(entering, f"_k {kind}, _chunk long, _enters long")
    bring = {key: F.col("_k"), "_chunk": F.col("_chunk"), "_t": F.col("_chunk") * width - 1}
    bring = enters.select(*(bring.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in cand.schema), "_enters")
    both = cand.withColumn("_enters", F.lit(None).cast("long")).unionByName(bring)
    out = sorted_groups(both, [key, "_chunk"], "_t", "_tie", "_row").mapInArrow(firing, cand.schema)
    return out.withColumn("detected_at_event_time", F.col("_t")).drop("_t", "_tie", "_row", "_chunk")


def streak_alerts(df: DataFrame, key: str, time_col: str, value_col: str, tie_col: str,
                  threshold: float = GRIDLOCK_WAIT_SEC, cycles: int = GRIDLOCK_CYCLES,
                  chunk_ms: int | None = None) -> DataFrame:
    """DET-2: alert on exactly the ``cycles``-th consecutive row with
    ``value > threshold`` per key; a row at or below resets, a null value is skipped, and so
    is a row without an event time.

    The feed is shuffled once, by (key, chunk). A window there gives each row its run of breaches
    since the last reset of its chunk. Rows behind such a reset are decided by that alone. The
    others have the breaches that end the chunks before to be added; they can alert only as one of
    the first ``cycles`` rows of their chunk, so these and the last row of each chunk (which tells how the chunk
    ends) are all that is put in order per key.
    """
    r = _ordered(df.where(F.col(value_col).isNotNull()), time_col, tie_col, chunk_ms)
    r = r.withColumn("_high", F.col(value_col) > F.lit(threshold))
    local = Window.partitionBy(key, "_chunk").orderBy(*_order())
    so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = r.withColumn("_pos", F.row_number().over(local)).withColumn("_ends", F.lead("_t").over(local).isNull())
    r = r.withColumn("_reset", F.max(F.when(~F.col("_high"), F.col("_pos"))).over(so_far))
    r = r.withColumn("_run", F.col("_pos") - F.coalesce("_reset", F.lit(0)))
    decided = r.where(F.col("_reset").isNotNull() & F.col("_high") & (F.col("_run") == cycles))

    edge = r.where((F.col("_reset").isNull() & F.col("_high") & (F.col("_run") <= cycles)) | F.col("_ends"))
    before = (Window.partitionBy(key).orderBy("_chunk", *_order())
              .rowsBetween(Window.unboundedPreceding, -1))
    tail = F.when(F.col("_ends"), F.col("_run")).otherwise(0)
    edge = edge.withColumn("_tails", F.coalesce(F.sum(tail).over(before), F.lit(0)))
    # what the chunks up to the last one with a reset add before its tail does not count
    stop = F.last(F.when(F.col("_ends") & F.col("_reset").isNotNull(), F.col("_tails")), ignorenulls=True)
    edge = edge.withColumn("_carried", F.col("_tails") - F.coalesce(stop.over(before), F.lit(0)))
    open_alerts = edge.where(F.col("_reset").isNull() & F.col("_high")
                             & (F.col("_run") + F.col("_carried") == cycles))
    out = decided.unionByName(open_alerts.drop("_tails", "_carried"))
    return (out.withColumn("consecutive_cycles_over_threshold", F.lit(cycles))
               .withColumn("detected_at_event_time", F.col("_t"))
               .drop("_t", "_tie", "_row", "_chunk", "_high", "_pos", "_ends", "_reset", "_run"))


def proximity_alerts(df: DataFrame, route: str, bus: str, time_col: str, lat: str, lon: str,
                     tie_col: str, distance_m: float = BUNCHING_DISTANCE_M,
                     duration_ms: int = BUNCHING_DURATION_MS,
                     fresh_ms: int = BUNCHING_FRESH_MS, chunk_ms: int | None = None) -> DataFrame:
    """DET-3 (+ JOIN-4): two vehicles of one route staying within ``distance_m``.

    Each fix of bus b is compared with the latest earlier fix of every other bus o of
    the route if that fix is at most ``fresh_ms`` old (a stale one is skipped and
    leaves the pair's clock alone). Close: the pair's clock starts if absent, and once
    it has run ``duration_ms`` one alert is raised (reporter = bus_id_1). Far: the clock
    is cleared.

    No pair enumeration per route: candidate pairs come from a space-time grid join over
    per-(bus, bucket, cell) summaries (cells of 2*distance on the unit sphere, buckets
    of 2*fresh); only candidate pairs get their observation sequence (as-of join on
    time buckets), limited to the span in which they met.
    """
    fx = _ordered(df.where(F.col(bus).isNotNull() & F.col(lat).isNotNull()
                           & F.col(lon).isNotNull()), time_col, tie_col, None)
    # equal rows are told apart here, so that each is an observation of its own
    fx = fx.withColumn("_row", F.monotonically_increasing_id())
    fx = fx.select(F.col(route).alias("_route"), F.col(bus).alias("_bus"), "_t", "_tie", "_row",
                   F.col(lat).alias("_lat"), F.col(lon).alias("_lon"),
                   F.col(time_col).alias("_ts_src"))
    fx = fx.checkpoint(eager=True)  # narrow fixes, read by four branches below
    cells, frac = unit_sphere_cells("_lat", "_lon", 2 * distance_m)

    # 1. candidate pairs: buses of a route that were in neighbouring cells within the
    #    freshness limit (a superset of pairs with a close observation). Fixes are first
    #    reduced to one row per (bus, time bucket, cell) with their time range, so a
    #    crowded cell (a terminal) joins buses with buses, not fixes with fixes.
    #    Grid cells are 2*distance wide on the unit sphere: a point's neighbours within
    #    distance lie in its own cell or the adjacent cell on its nearer side (2 per
    #    axis). Time buckets are 2*fresh wide: a fix in the second half of its bucket
    #    only needs its own bucket, one in the first half also the previous one.
    gw = 2 * fresh_ms
    cell_cols = [c.alias(f"_c{i}") for i, c in enumerate(cells)]
    near_cols = [F.when(f < 0.5, c - 1).otherwise(c + 1).alias(f"_n{i}")
                 for i, (c, f) in enumerate(zip(cells, frac))]
    fxc = fx.select("_route", "_bus", "_t", F.floor(F.col("_t") / gw).cast("long").alias("_gb"),
                    ((F.col("_t") - F.floor(F.col("_t") / gw) * gw) < fresh_ms).alias("_early"),
                    *cell_cols, *near_cols)
    other = fxc.groupBy("_route", F.col("_bus").alias("_obus"), "_gb", "_c0", "_c1", "_c2") \
               .agg(F.min("_t").alias("_omin"), F.max("_t").alias("_omax"))
    pg = fxc.groupBy("_route", "_bus", "_gb", "_early", "_c0", "_c1", "_c2",
                     "_n0", "_n1", "_n2").agg(F.min("_t").alias("_pmin"),
                                              F.max("_t").alias("_pmax"))
    def cells_at(dt: int) -> list[str]:
        return [f"named_struct('gb', _gb - {dt}, " + ", ".join(
            f"'c{i}', {'_n' if (m >> i) & 1 else '_c'}{i}" for i in range(3)) + ")"
            for m in range(8)]
    combos = F.expr(f"CASE WHEN _early THEN array({', '.join(cells_at(0) + cells_at(1))}) "
                    f"ELSE array({', '.join(cells_at(0))}) END")
    probe = pg.select("_route", "_bus", "_pmin", "_pmax",
                      F.inline(combos).alias("_gb", "_c0", "_c1", "_c2"))
    # necessary for a close observation at reporter time t with partner fix time u:
    # omin <= u <= t <= pmax and omax >= u >= t - fresh >= pmin - fresh
    close = probe.join(other, on=["_route", "_gb", "_c0", "_c1", "_c2"]).where(
        (F.col("_obus") != F.col("_bus")) & (F.col("_omin") <= F.col("_pmax"))
        & (F.col("_omax") >= F.col("_pmin") - fresh_ms))
    pairs = close.groupBy("_route", F.least("_bus", "_obus").alias("_a"),
                          F.greatest("_bus", "_obus").alias("_b")).agg(
        F.min("_pmin").alias("_from"), F.max("_pmax").alias("_to"))

    # 2. observations of those pairs: each fix of either bus, inside the span in which
    #    the pair met, against the latest earlier fix of the partner if it is fresh.
    both = pairs.select("_route", F.col("_a").alias("_bus"), F.col("_b").alias("_partner"),
                        "_from", "_to").unionByName(
        pairs.select("_route", F.col("_b").alias("_bus"), F.col("_a").alias("_partner"),
                     "_from", "_to"))
    rep = fx.join(both, ["_route", "_bus"]).where(
        F.col("_t").between(F.col("_from"), F.col("_to")))
    # The as-of lookup is a sorted pass, linear in the fixes, however dense they are.
    probes = rep.select("_route", "_bus", "_partner", F.col("_t").alias("p_time"),
                        F.struct("_tie", "_row").alias("p_tie"), "_lat", "_lon", "_ts_src")
    partner_fix = fx.select("_route", F.col("_bus").alias("_partner"), "_t", "_tie", "_row",
                            "_lat", "_lon").join(
        both.select("_route", "_bus", "_partner", "_from", "_to"), ["_route", "_partner"]) \
        .where(F.col("_t").between(F.col("_from") - fresh_ms, F.col("_to")))
    targets = partner_fix.select("_route", "_bus", "_partner", F.col("_t").alias("t_time"),
                                 F.struct("_tie", "_row").alias("t_tie"),
                                 F.struct(F.col("_lat").alias("_plat"),
                                          F.col("_lon").alias("_plon")).alias("t_val"))
    seen = last_before(probes, targets, ["_route", "_bus", "_partner"], fresh_ms)
    obs = seen.select("_route", "_bus", "_partner", F.col("p_time").alias("_t"),
                      F.col("p_tie._tie").alias("_tie"), F.col("p_tie._row").alias("_row"), "_lat", "_lon",
                      "_ts_src",
                      F.col("t_val").alias("_p"))
    dist = haversine_m("_lat", "_lon", "_p._plat", "_p._plon")
    obs = obs.select("*", dist.alias("_dist"), pair_key("_bus", "_partner").alias("_pair"),
                     (dist <= distance_m).alias("_close"))
    obs = obs.withColumn("_chunk", F.floor(F.col("_t") / (chunk_ms or DAY_MS)).cast("long"))
    obs = obs.checkpoint(eager=True)  # read four times below

    # 3. streaks of close observations per pair: a far observation starts a new one.
    pk = ["_route", "_pair"]
    obs = prefix_scan(obs, pk, _order(), "_chunk",
                      [("_streak", "sum", (~F.col("_close")).cast("long"))])
    first = obs.where("_close").groupBy(*pk, "_streak").agg(F.min("_t").alias("_first"))
    cand = obs.where("_close").join(first, pk + ["_streak"]).where(
        F.col("_t") - F.col("_first") >= duration_ms)
    alert = cand.groupBy(*pk, "_streak").agg(F.min_by(
        F.struct("_bus", "_partner", "_dist", "_t", "_tie", "_first", "_ts_src"),
        F.struct("_t", "_tie", "_row")).alias("a"))
    return alert.select(
        F.col("_route").alias("route_id"),
        F.col("a._bus").alias("bus_id_1"),
        F.col("a._partner").alias("bus_id_2"),
        F.round(F.col("a._dist"), 1).alias("distance_m"),
        F.floor((F.col("a._t") - F.col("a._first")) / 1000).cast("long")
         .alias("continuous_proximity_sec"),
        F.col("a._ts_src").alias("source_time"),
        F.nullif(F.col("a._tie"), F.lit(NO_TIE)).alias("tie"),
        F.col("a._t").alias("detected_at_event_time"),
    )
