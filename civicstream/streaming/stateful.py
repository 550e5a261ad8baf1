"""DET-1..3 on streams (``transformWithState``, event-time mode).

State is kept for groups of keys, and rows travel and wait as packs: Arrow batches of the rows of one
group. A key has a few rows in a micro-batch and a group thousands, so that calls of the state API,
timers and array code are paid for by group. A group's packs wait in list state, with a timer at the
earliest row of those that came together. When the watermark passes it, all rows that are ready are
taken out at once, put in order by (key, event time, tie), and handled by array code together with what
is carried over from earlier rows: the last firing of a sensor, the number of breaches in a row of a
junction, the last position of a bus, the running clock of a pair of buses. So a stream gives the same
alerts as the batch detectors, in however many micro-batches the rows arrive. Rows that are not newer
than the watermark at which their group was last handled are dropped.

Buses are never kept by route. A fix and the latest fresh fix of each other bus of the route before it
are found by (route, time bucket), with each fix also copied to the next bucket; far ones count,
because they stop the clock, so the place is no key. State is per pair of buses, and only while its
clock runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from civicstream.functions.geo import haversine_m
from civicstream.functions.timecols import epoch_ms
from civicstream.operators.incidents import aqi_incidents, bunching_incidents, gridlock_incidents
from civicstream.session import ensure_rocksdb_state
from civicstream.schemas import (AQI_COOLDOWN_MS, AQI_HAZARDOUS, BUNCHING_DISTANCE_M, BUNCHING_DURATION_MS,
                                 BUNCHING_FRESH_MS, DETECTOR_WATERMARK, GRIDLOCK_CYCLES, GRIDLOCK_WAIT_SEC,
                                 INCIDENT_COLUMNS)

INCIDENT_DDL = ", ".join(f"{n} {t.simpleString()}" for n, t in INCIDENT_COLUMNS)

#: Groups of keys of a detector, and rows for which there is one more. A checkpoint keeps its number.
GROUPS = 256
GROUP_ROWS = 100_000
#: Rows packed, and observations made, at a time.
BLOCK_ROWS = 500_000

LONG, TEXT, REAL, FLAG = pa.int64(), pa.string(), pa.float64(), pa.bool_()


def state_groups(rows: int) -> int:
    """Groups of keys for a stream that starts with so many rows."""
    return max(GROUPS, -(-rows // GROUP_ROWS))


def _schema(**columns) -> pa.Schema:
    return pa.schema(list(columns.items()))


def _pack(rows: pa.Table) -> bytes:
    """Rows of one batch, without their schema."""
    batches = rows.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], rows.schema)]
    return batches[0].serialize().to_pybytes()


def _unpack(packs, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(p), schema) for p in packs], schema)


def _packed(df: DataFrame, keys: list[str], schema: pa.Schema, groups: int) -> DataFrame:
    """``df`` as packs by group of ``keys``, with the earliest ``t`` of each."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            part = rows.column("part").to_numpy()
            order = np.argsort(part, kind="stable")
            rows, part = rows.drop_columns("part").take(pa.array(order)).cast(schema).combine_chunks(), part[order]
            edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            first = np.minimum.reduceat(rows.column("t").to_numpy(), edges[:-1])
            return pa.RecordBatch.from_arrays(
                [pa.array(part[edges[:-1]], pa.int32()), pa.array(first),
                 pa.array([_pack(rows.slice(a, b - a)) for a, b in zip(edges, edges[1:])], pa.binary())],
                ["part", "first", "rows"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield packs(held)
                held = []
        if held:
            yield packs(held)

    part = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("part")
    return df.where("t IS NOT NULL").select(part, *schema.names).mapInArrow(pack, "part int, first long, rows binary")


def _by_group(df: DataFrame, processor: _InOrder, groups: int) -> DataFrame:
    """What ``processor`` gives for the rows of ``df``, in its schema ``out``."""
    out = processor.out

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0):
                yield pa.ipc.read_record_batch(pa.py_buffer(p.as_py()), out)

    packs = _packed(df, processor.keys, processor.row, groups)
    return packs.groupBy("part").transformWithState(processor, "rows binary", "Append", "EventTime").mapInArrow(
        unpack, from_arrow_schema(out))


class _Keys:
    """Numbers for the keys of several tables, 0 and up; nulls are equal."""

    def __init__(self, names: list[str], *tables: pa.Table):
        self.values = pa.concat_tables([t.select(names) for t in tables]).combine_chunks()
        code = np.zeros(self.values.num_rows, np.int64)
        for name in names:
            column = self.values.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            code = np.unique(code * (int(column.max(initial=0)) + 1) + column, return_inverse=True)[1]
        self.count = int(code.max(initial=-1)) + 1
        self.of = np.split(code, np.cumsum([t.num_rows for t in tables])[:-1])
        self.place = np.zeros(self.count, np.int64)
        self.place[code] = np.arange(len(code))

    def rows(self, codes: np.ndarray, **columns: np.ndarray) -> pa.Table:
        """The keys with these numbers, and further columns."""
        found = self.values.take(pa.array(self.place[codes]))
        return reduce(lambda t, c: t.append_column(c[0], pa.array(c[1])), columns.items(), found)


def _number(rows: pa.Table, name: str) -> np.ndarray:
    """A column of doubles, null as NaN."""
    return rows.column(name).combine_chunks().fill_null(float("nan")).to_numpy()


def _tie(rows: pa.Table, name: str = "tie") -> tuple[np.ndarray, np.ndarray]:
    """The tie (0 if null), and whether there is one; to be sorted by the latter first."""
    tie = rows.column(name).combine_chunks()
    return tie.fill_null(0).to_numpy(), tie.is_valid().to_numpy(zero_copy_only=False)


def _sorted(code: np.ndarray, rows: pa.Table) -> np.ndarray:
    tie, known = _tie(rows)
    return np.lexsort((tie, known, rows.column("t").to_numpy(), code))


def _starts(code: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(code, prepend=-1))


class _Times:
    """Places in rows sorted by (code, t)."""

    def __init__(self, code: np.ndarray, t: np.ndarray):
        self.times, rank = np.unique(t, return_inverse=True)
        self.at = code * (len(self.times) + 1) + rank

    def first(self, code: np.ndarray, t: np.ndarray, side: str = "left") -> np.ndarray:
        """The first row of each code at ``t`` or later (``side`` right: later), or the end of the code's rows."""
        return np.searchsorted(self.at, code * (len(self.times) + 1) + np.searchsorted(self.times, t, side))


class _InOrder(StatefulProcessor):
    """Hands the rows that the watermark has passed by ``hold_ms`` to ``alerts``."""

    keys: list[str]
    #: Schemas of a waiting row (with t and tie), of what is carried over, and of what comes out.
    row: pa.Schema
    carry: pa.Schema
    out: pa.Schema
    hold_ms = 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.carried = handle.getValueState("carried", "done long, rows binary")
        self.handled: dict = {}

    def alerts(self, rows: pa.Table, carried: pa.Table, upto: int) -> tuple[Iterator[pa.Table], pa.Table]:
        """What comes out for rows up to the time ``upto``, and what to carry over."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        packs = [(r["first"], r["rows"]) for r in rows]
        self.waiting.appendList([(bytes(p),) for _, p in packs])
        self.handle.registerTimer(min(first for first, _ in packs) + self.hold_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs() - self.hold_ms
        if self.handled.get(key) == upto:                  # taken out by an earlier timer
            return
        self.handled[key] = upto
        before = self.carried.get()
        rows = _unpack((p[0] for p in self.waiting.get()), self.row)
        t = rows.column("t").to_numpy()
        known = np.ones(len(t), bool) if before is None else t > before[0]
        later = rows.filter(pa.array(known & (t > upto)))
        ready = rows.filter(pa.array(known & (t <= upto)))
        if later.num_rows:
            self.waiting.put([(_pack(later),)])
            self.handle.registerTimer(int(later.column("t").to_numpy().min()) + self.hold_ms)
        else:
            self.waiting.clear()
        if not ready.num_rows:
            return
        out, after = self.alerts(ready.combine_chunks(), _unpack([] if before is None else [before[1]], self.carry), upto)
        for table in out:
            if table.num_rows:
                yield Row(rows=_pack(table.cast(self.out)))
        self.carried.update((upto, _pack(after.cast(self.carry))))

    def close(self) -> None:
        pass


class Cooldown(_InOrder):
    """DET-1: carried over is the time of the last firing, while its cooldown runs. The next one is the
    first hazardous reading a cooldown later."""

    keys = ["sensor_id"]
    row = _schema(t=LONG, tie=LONG, aqi=REAL, sensor_id=TEXT, zone=TEXT, ts=TEXT)
    carry = _schema(sensor_id=TEXT, last=LONG)
    out = _schema(source_timestamp=TEXT, detected_at_event_time=LONG, sensor_id=TEXT, zone=TEXT, aqi=REAL)

    def __init__(self, threshold=AQI_HAZARDOUS, cooldown_ms=AQI_COOLDOWN_MS):
        self.threshold, self.cooldown_ms = threshold, cooldown_ms

    def alerts(self, rows, carried, upto):
        rows = rows.filter(pa.array(_number(rows, "aqi") > self.threshold)).combine_chunks()
        keys = _Keys(self.keys, carried, rows)
        order = _sorted(keys.of[1], rows)
        code, t = keys.of[1][order], rows.column("t").to_numpy()[order]
        last, fired_before = np.zeros(keys.count, np.int64), np.zeros(keys.count, bool)
        last[keys.of[0]], fired_before[keys.of[0]] = carried.column("last").to_numpy(), True
        places = _Times(code, t)
        due = np.maximum(places.first(code, t + self.cooldown_ms), np.arange(len(t)) + 1).tolist()
        starts = _starts(code)
        mine = code[starts]
        enter = np.where(fired_before[mine], places.first(mine, last[mine] + self.cooldown_ms), starts)
        fired = []
        for at, end in zip(enter.tolist(), np.append(starts, len(t))[1:].tolist()):
            while at < end:
                fired.append(at)
                at = due[at]
        fired = np.array(fired, np.int64)
        last[code[fired]] = t[fired]
        fired_before[code[fired]] = True
        of = rows.take(pa.array(order[fired]))
        out = pa.table([of.column("ts"), of.column("t"), of.column("sensor_id"), of.column("zone"), of.column("aqi")],
                       names=self.out.names)
        running = np.flatnonzero(fired_before & (last + self.cooldown_ms > upto))
        return iter([out]), keys.rows(running, last=last[running])


class Streak(_InOrder):
    """DET-2: carried over is the number of breaches at the end, up to one more than the number that
    alerts. The length of the run at each row is its distance from the last row that was no breach."""

    keys = ["junction_id"]
    row = _schema(t=LONG, tie=LONG, wait=REAL, junction_id=TEXT, zone=TEXT, ts=TEXT)
    carry = _schema(junction_id=TEXT, breaches=LONG)
    out = _schema(source_timestamp=TEXT, detected_at_event_time=LONG, junction_id=TEXT, zone=TEXT, avg_wait_sec=REAL,
                  consecutive_cycles_over_threshold=pa.int32())

    def __init__(self, threshold=GRIDLOCK_WAIT_SEC, cycles=GRIDLOCK_CYCLES):
        self.threshold, self.cycles = threshold, cycles

    def alerts(self, rows, carried, upto):
        rows = rows.filter(rows.column("wait").is_valid()).combine_chunks()
        keys = _Keys(self.keys, carried, rows)
        order = _sorted(keys.of[1], rows)
        code = keys.of[1][order]
        breaches = np.zeros(keys.count, np.int64)
        breaches[keys.of[0]] = carried.column("breaches").to_numpy()
        breach = _number(rows, "wait")[order] > self.threshold
        at, starts = np.arange(len(code)), _starts(code)
        begins = np.zeros(len(code), bool)
        begins[starts] = True
        reset = np.maximum.accumulate(np.where(~breach | begins, at, 0))
        run = at - reset + np.where(breach[reset], 1 + breaches[code], 0)
        of = rows.take(pa.array(order[np.flatnonzero(breach & (run == self.cycles))]))
        out = pa.table([of.column("ts"), of.column("t"), of.column("junction_id"), of.column("zone"), of.column("wait"),
                        pa.array(np.full(of.num_rows, self.cycles, np.int32))], names=self.out.names)
        # one breach beyond the alert is told apart from the one that alerts
        ends = np.append(starts, len(code))[1:] - 1
        breaches[code[ends]] = np.minimum(run[ends], self.cycles + 1)
        left = np.flatnonzero(breaches)
        return iter([out]), keys.rows(left, breaches=breaches[left])


class Sightings(_InOrder):
    """JOIN-4: every fix with the latest fix before it of each other bus of its route, if that is at
    most ``fresh_ms`` old. Keys are (route, time bucket); ``copy`` marks fixes of the bucket before,
    which are only seen. Carried over is the last fix of each bus, while it is fresh.

    A fix is the latest of its bus from the first row after it to the first row after the bus's next
    one, so the rows that see it are one range of the ordered rows, and the work is that of the ranges.
    Fixes wait until they are no longer fresh: alerts of pairs follow the watermark at that distance."""

    keys = ["route_id", "bucket"]
    row = _schema(t=LONG, tie=LONG, route_id=TEXT, bucket=LONG, bus_id=TEXT, lat=REAL, lon=REAL, ts=TEXT, copy=FLAG)
    carry = row
    out = _schema(route_id=TEXT, bus=TEXT, other=TEXT, t=LONG, tie=LONG, u=LONG, utie=LONG, ts=TEXT, lat=REAL, lon=REAL,
                  p_lat=REAL, p_lon=REAL)

    def __init__(self, fresh_ms=BUNCHING_FRESH_MS):
        self.fresh_ms = self.hold_ms = fresh_ms

    def alerts(self, rows, carried, upto):
        rows = pa.concat_tables([carried, rows]).combine_chunks()
        code, bus = _Keys(self.keys, rows).of[0], _Keys([*self.keys, "bus_id"], rows).of[0]
        order = _sorted(code, rows)
        rows, code, bus = rows.take(pa.array(order)), code[order], bus[order]
        here = ~rows.column("copy").to_numpy() & (order >= carried.num_rows)
        t, (tie, known) = rows.column("t").to_numpy(), _tie(rows)
        n = len(t)

        def run_ends(*columns):
            """The first row with another value."""
            new = np.ones(n, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = np.flatnonzero(new)
            return np.append(starts, n)[1:][np.cumsum(new) - 1]

        # the first row that comes later; rows of one time come after another only by their ties
        seen = np.where(known, run_ends(code, t, known, tie), run_ends(code, t))
        by_bus = np.argsort(bus, kind="stable")
        offset = bus[by_bus] * (n + 1)
        replaced = np.minimum.accumulate((seen[by_bus] + offset)[::-1])[::-1]
        until = np.full(n, n)
        same = bus[by_bus][1:] == bus[by_bus][:-1]
        until[by_bus[:-1][same]] = (replaced - offset)[1:][same]
        until = np.minimum(until, _Times(code, t).first(code, t + self.fresh_ms, "right"))

        seeing, before = np.flatnonzero(here), np.append(0, np.cumsum(here))
        low = before[seen]
        many = np.maximum(before[until] - low, 0)
        newest = by_bus[np.append(~same, True)[:n]]
        kept = np.sort(newest[(t[newest] + self.fresh_ms > upto)
                              & ((rows.column("bucket").to_numpy()[newest] + 1) * self.fresh_ms - 1 > upto)])
        return self._pairs(rows, bus, seeing, low, many), rows.take(pa.array(kept))

    def _pairs(self, rows, bus, seeing, low, many) -> Iterator[pa.Table]:
        total = np.cumsum(many)
        edges = np.searchsorted(total, np.arange(BLOCK_ROWS, int(total[-1]) + BLOCK_ROWS, BLOCK_ROWS), "left") + 1
        for a, b in zip([0, *edges.tolist()], edges.tolist()):
            b = min(b, len(many))
            if a >= b:
                continue
            past = np.repeat(np.arange(a, b), many[a:b])
            step = np.arange(len(past)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
            fix = seeing[low[past] + step]
            other = bus[fix] != bus[past]
            e, p = rows.take(pa.array(fix[other])), rows.take(pa.array(past[other]))
            yield pa.table([e.column("route_id"), e.column("bus_id"), p.column("bus_id"), e.column("t"), e.column("tie"),
                            p.column("t"), p.column("tie"), e.column("ts"), e.column("lat"), e.column("lon"),
                            p.column("lat"), p.column("lon")], names=self.out.names)


class PairClock(_InOrder):
    """DET-3 of pairs of buses. Rows are a fix and an earlier fresh fix of the other bus; of several for
    one fix the latest counts. Carried over are the start of the running clock and the last close
    observation."""

    keys = ["route_id", "bus_a", "bus_b"]
    row = _schema(t=LONG, tie=LONG, route_id=TEXT, bus_a=TEXT, bus_b=TEXT, by_a=FLAG, u=LONG, utie=LONG, distance=REAL,
                  ts=TEXT)
    carry = _schema(route_id=TEXT, bus_a=TEXT, bus_b=TEXT, first=LONG, last=LONG)
    out = _schema(source_timestamp=TEXT, detected_at_event_time=LONG, route_id=TEXT, bus_id_1=TEXT, bus_id_2=TEXT,
                  distance_m=REAL, continuous_proximity_sec=LONG)

    def __init__(self, distance_m=BUNCHING_DISTANCE_M, duration_ms=BUNCHING_DURATION_MS, hold_ms=0):
        self.distance_m, self.duration_ms, self.hold_ms = distance_m, duration_ms, hold_ms

    def alerts(self, rows, carried, upto):
        keys = _Keys(self.keys, carried, rows)
        code, t, by_a = keys.of[1], rows.column("t").to_numpy(), rows.column("by_a").to_numpy()
        (tie, known), (utie, uknown) = _tie(rows), _tie(rows, "utie")
        order = np.lexsort((utie, uknown, rows.column("u").to_numpy(), by_a, tie, known, t, code))
        one = [c[order] for c in (code, t, known, tie, by_a)]
        order = order[np.append(np.any([c[1:] != c[:-1] for c in one], axis=0), True)]
        code, t = code[order], t[order]
        far = _number(rows, "distance")[order] > self.distance_m
        n, starts = len(t), _starts(code)
        begins = np.zeros(n, bool)
        begins[starts] = True

        first, last, clock = np.zeros(keys.count, np.int64), np.zeros(keys.count, np.int64), np.zeros(keys.count, bool)
        first[keys.of[0]], last[keys.of[0]] = carried.column("first").to_numpy(), carried.column("last").to_numpy()
        clock[keys.of[0]] = True

        # a far observation begins a new stretch, as does a pair; the close ones of a stretch have one start
        stretch = np.cumsum(far | begins) - 1
        opens = far[np.flatnonzero(far | begins)]          # whether a far one begins the stretch
        close = np.flatnonzero(~far)
        begun, at = np.unique(stretch[close], return_index=True)
        start, done = np.zeros(stretch[-1] + 1, np.int64), np.zeros(stretch[-1] + 1, bool)
        pair, start[begun] = code[close[at]], t[close[at]]
        goes_on = clock[pair] & ~opens[begun]
        start[begun[goes_on]] = first[pair[goes_on]]
        done[begun[goes_on]] = (last - first)[pair[goes_on]] >= self.duration_ms
        long = close[(t[close] - start[stretch[close]] >= self.duration_ms) & ~done[stretch[close]]]
        fired = long[np.unique(stretch[long], return_index=True)[1]]
        of = rows.take(pa.array(order[fired]))
        a, b, mine = of.column("bus_a"), of.column("bus_b"), by_a[order[fired]]
        out = pa.table([of.column("ts"), of.column("t"), of.column("route_id"), _either(mine, a, b), _either(mine, b, a),
                        pa.array([round(d, 1) for d in of.column("distance").to_pylist()], REAL),
                        pa.array((t[fired] - start[stretch[fired]]) // 1000)], names=self.out.names)

        ends = np.append(starts, n)[1:] - 1
        clock[code[ends]] = ~far[ends]
        first[code[ends]], last[code[ends]] = start[stretch[ends]], t[ends]
        running = np.flatnonzero(clock)
        return iter([out]), keys.rows(running, first=first[running], last=last[running])


def _either(condition: np.ndarray, a: pa.ChunkedArray, b: pa.ChunkedArray) -> pa.Array:
    both = pa.concat_arrays([*a.chunks, *b.chunks]) if a.num_chunks else pa.array([], a.type)
    return both.take(pa.array(np.arange(len(condition)) + np.where(condition, 0, len(condition))))


def _prepare(df: DataFrame, time_col: str, tie_col: str, delay: str) -> DataFrame:
    """t, tie, ts (the source's timestamp text) and the watermarked time of every row."""
    ensure_rocksdb_state(df.sparkSession)
    time = F.col(time_col).cast("timestamp")
    text = (F.col("timestamp") if dict(df.dtypes).get("timestamp") == "string"
            else F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return (df.withColumn("_at", time).withWatermark("_at", delay)
              .withColumn("t", epoch_ms(time)).withColumn("tie", F.col(tie_col).cast("long"))
              .withColumn("ts", text))


def stream_aqi(df: DataFrame, time_col="event_time", tie_col="offset", delay=DETECTOR_WATERMARK,
               groups: int = GROUPS, **params) -> DataFrame:
    # all readings go in: Spark would move a filter below the watermark, which they move too
    rows = _prepare(df, time_col, tie_col, delay)
    return aqi_incidents(_by_group(rows, Cooldown(**params), groups))


def stream_gridlock(df: DataFrame, time_col="event_time", tie_col="offset", delay=DETECTOR_WATERMARK,
                    groups: int = GROUPS, **params) -> DataFrame:
    rows = _prepare(df, time_col, tie_col, delay).withColumn("wait", F.col("avg_wait_sec"))
    return gridlock_incidents(_by_group(rows, Streak(**params), groups))


def pair_observations(df: DataFrame, time_col="event_time", tie_col="offset", delay=DETECTOR_WATERMARK,
                      fresh_ms: int = BUNCHING_FRESH_MS, groups: int = GROUPS) -> DataFrame:
    """JOIN-4 on a stream: every fix with the latest earlier fix of each other bus of its route that is
    at most ``fresh_ms`` old."""
    fixes = _prepare(df, time_col, tie_col, delay).where(
        "route_id IS NOT NULL AND bus_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    bucket = F.floor(F.col("t") / fresh_ms).cast("long")
    fixes = fixes.withColumn("_in", F.explode(F.array(*[
        F.struct((bucket + k).alias("bucket"), F.lit(k == 1).alias("copy")) for k in (0, 1)])))
    seen = _by_group(fixes.select("*", "_in.*"), Sightings(fresh_ms), groups)
    return seen.select("route_id", F.least("bus", "other").alias("bus_a"), F.greatest("bus", "other").alias("bus_b"),
                       "bus", "other", "t", "tie", "u", "utie", "ts",
                       haversine_m("lat", "lon", "p_lat", "p_lon").alias("distance"))


def stream_bunching(df: DataFrame, time_col="event_time", tie_col="offset", delay=DETECTOR_WATERMARK,
                    fresh_ms: int = BUNCHING_FRESH_MS, groups: int = GROUPS, **params) -> DataFrame:
    """Alerts follow the watermark at a distance of ``fresh_ms``, by which the observations do."""
    seen = pair_observations(df, time_col, tie_col, delay, fresh_ms, groups)
    seen = seen.withColumn("by_a", F.col("bus") == F.col("bus_a"))
    return bunching_incidents(_by_group(seen, PairClock(hold_ms=fresh_ms, **params), groups))
