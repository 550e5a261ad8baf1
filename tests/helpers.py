"""Small helpers, and what an alert means written as a condition on each row and the rows before it."""

from __future__ import annotations

import datetime as dt
import json
from bisect import bisect_left
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from civicstream.functions.jsoncols import parse_value
from civicstream.schemas import RAW_SCHEMAS


def messages(spark, records: list, feed: str):
    """Envelope-like frame from Python dicts (or raw strings for malformed lines)."""
    rows = [(r if isinstance(r, str) else json.dumps(r), i) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "value string, offset long")


def parsed(spark, records: list, feed: str):
    return parse_value(messages(spark, records, feed), RAW_SCHEMAS[feed])


def iso(sec: float, base: str = "2026-07-01T06:00:00") -> str:
    t = dt.datetime.fromisoformat(base) + dt.timedelta(seconds=sec)
    return t.strftime("%Y-%m-%dT%H:%M:%S") + ("." + f"{t.microsecond:06d}" if t.microsecond else "") + "Z"


def by_key(rows):
    """Rows (key, t, tie, ...) of each key in order."""
    out = {}
    for r in sorted(rows, key=lambda r: r[1:3]):
        out.setdefault(r[0], []).append(r)
    return out


def expected_cooldown(rows, threshold, cooldown):
    """(key, tie) of the readings above the threshold that no alert precedes by less than the
    cooldown."""
    out = set()
    for key, seq in by_key(rows).items():
        alerts = []
        for _, t, tie, v in seq:
            if v is not None and v > threshold and not any(t - a < cooldown for a in alerts):
                alerts.append(t)
                out.add((key, tie))
    return out


def expected_streaks(rows, threshold, cycles):
    """(key, tie) of the rows that end exactly ``cycles`` breaches in a row."""
    out = set()
    for key, seq in by_key(rows).items():
        seq = [r for r in seq if r[3] is not None]
        for i in range(cycles - 1, len(seq)):
            window = seq[max(0, i - cycles):i + 1]
            high = [r[3] > threshold for r in window]
            if all(high[-cycles:]) and not all(high[:-cycles] or [False]):
                out.add((key, seq[i][2]))
    return out


def chord(lat1, lon1, lat2, lon2, radius=6371000.0):
    """Great-circle distance by way of the straight line between the points."""
    lat, lon = np.radians([lat1, lat2]), np.radians([lon1, lon2])
    x = np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])
    return 2 * radius * np.arcsin(min(1.0, np.linalg.norm(x[:, 0] - x[:, 1]) / 2))


def expected_bunching(rows, distance, duration, fresh):
    """(route, reporter, other, tie, seconds) of each pair's first observation of a stretch of close
    ones that is at least ``duration`` after the stretch's first. rows: (route, bus, t, tie, lat, lon)."""
    fixes = {}
    for route, bus, t, tie, lat, lon in rows:
        fixes.setdefault(route, {}).setdefault(bus, []).append((t, tie, lat, lon))
    out = set()
    for route, buses in fixes.items():
        for fs in buses.values():
            fs.sort()
        for pair in combinations(sorted(buses), 2):
            seen = []
            for bus, other in (pair, pair[::-1]):
                for t, tie, lat, lon in buses[bus]:
                    k = bisect_left(buses[other], (t, tie)) - 1
                    if k >= 0 and t - buses[other][k][0] <= fresh:
                        close = chord(lat, lon, *buses[other][k][2:]) <= distance
                        seen.append((t, tie, bus, other, close))
            seen.sort()
            for i, (t, tie, bus, other, close) in enumerate(seen):
                if not close:
                    continue
                begin = max((j + 1 for j in range(i) if not seen[j][4]), default=0)
                start = seen[begin][0]
                if t - start >= duration and all(seen[j][0] - start < duration for j in range(begin, i)):
                    out.add((route, bus, other, tie, (t - start) // 1000))
    return out


def collect_set(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.select(*cols).collect()}


def ts_col(df, c="event_time"):
    return df.withColumn(c, F.col(c).cast("timestamp"))
