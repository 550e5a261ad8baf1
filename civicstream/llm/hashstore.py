"""Sorted hash arrays in the shared folder, memory-mapped by the tasks that look keys up.

A store is split into shards by the upper bits of its 64-bit keys. A shard is one file of
ascending keys and one file per value column. Any task maps the files it touches, so a store may
be larger than a task's memory; only the list of shards (one row each) is held by the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.llm import common, files

#: Keys gathered in a task before they are sorted, counted and handed on.
FLUSH_KEYS = 1 << 21


def shard_bits(spark: SparkSession) -> int:
    """Upper key bits that tell the shard: at least as many shards as shuffle partitions."""
    return max(4, (common.partitions(spark) - 1).bit_length())


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int32)


PACKED = "shard int, keys binary, counts binary"


def packed(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, its keys, their counts) of distinct ascending keys."""
    edges = np.searchsorted(shard_of(keys, bits), np.arange((1 << bits) + 1))
    rows = np.flatnonzero(np.diff(edges))
    if len(rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)),
             pa.array([_steps(keys[edges[r]:edges[r + 1]]) for r in rows], pa.binary()),
             pa.array([_small(counts[edges[r]:edges[r + 1]]) for r in rows], pa.binary())],
            ["shard", "keys", "counts"])


def _small(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest, which the first byte tells."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << (8 * w))
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


#: Marks rows of steps whose upper byte is split off, and upper bytes that do not fit in four bits.
SPLIT, ESCAPE = 0x80, 15


def _steps(keys: np.ndarray) -> bytes:
    """Ascending keys as the first one and the differences, these in as many bytes as they need. The
    upper byte of the differences of hashes is small but for a few: where it saves space it takes four
    bits, and the larger ones follow whole."""
    steps = np.diff(keys).astype("<u8")
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    each = steps.view(np.uint8).reshape(-1, 8)
    first = keys[:1].astype("<u8").tobytes()
    upper = each[:, width - 1]
    large = upper >= ESCAPE
    if width == 1 or 2 * int(large.sum()) >= len(steps):
        return bytes([width]) + first + each[:, :width].tobytes()
    half = np.zeros(len(steps) + len(steps) % 2, np.uint8)
    half[:len(steps)] = np.minimum(upper, ESCAPE)
    return (bytes([SPLIT | width]) + first + np.array([len(steps)], "<u4").tobytes()
            + (half[::2] | half[1::2] << 4).tobytes() + each[:, :width - 1].tobytes() + upper[large].tobytes())


def _keys(data: bytes) -> np.ndarray:
    width, split = data[0] & ~SPLIT, data[0] & SPLIT
    n = int(np.frombuffer(data, "<u4", 1, 9)[0]) if split else (len(data) - 9) // width
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, 8, 1)
    if split:
        half = np.frombuffer(data, np.uint8, (n + 1) // 2, 13)
        upper = np.stack([half & ESCAPE, half >> 4], 1).ravel()[:n]
        low = 13 + len(half)
        steps[1:, :width - 1] = np.frombuffer(data, np.uint8, n * (width - 1), low).reshape(n, width - 1)
        upper[upper == ESCAPE] = np.frombuffer(data, np.uint8, offset=low + n * (width - 1)) if len(
            data) > low + n * (width - 1) else 0
        steps[1:, width - 1] = upper
    else:
        steps[1:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(n, width) if n else 0
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class Counter:
    """Counts keys; hands packed rows on whenever enough have gathered."""

    def __init__(self, bits: int, limit: int = FLUSH_KEYS):
        self.bits, self.limit = bits, limit
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(keys)
        self.size += len(keys)
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys = np.concatenate(self.held)
            self.held, self.size = [], 0
            yield from packed(*counted(keys), self.bits)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending keys and their total counts. Keys without counts are sorted in place."""
    if counts is None:
        keys.sort()
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def merged(rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and total counts of packed rows of one shard."""
    if not rows:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return counted(np.concatenate([_keys(k) for k, _ in rows]),
                   np.concatenate([_counts(c) for _, c in rows]))


def shards(packed_rows: DataFrame, make: Callable[[int, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]],
           schema: str) -> DataFrame:
    """Call ``make(shard, keys, counts)`` for each shard with all its keys, in one task each."""
    n = 1 << shard_bits(packed_rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        size, current = 0, None
        for batch in batches:
            for shard, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if held:
                        yield from make(current, *merged(held))
                    held, size, current = [], 0, shard
                held.append((keys, counts))
                size += len(keys)
                if size > 8 * 4 * FLUSH_KEYS:     # many small rows of common keys: add them up
                    k, c = merged(held)
                    held, size = [(_steps(k), _small(c))], 0
        if held:
            yield from make(current, *merged(held))

    return (packed_rows.repartitionById(n, "shard").sortWithinPartitions("shard")
            .mapInArrow(run, schema))


class Store:
    """The files of a store: by shard, the file name without extension and the number of keys.
    Values are unsigned integers in as many bytes as the shard needs."""

    def __init__(self, folder: str, bits: int, names: dict[int, tuple[str, int]], values: tuple[str, ...] = ()):
        self.folder, self.bits, self.names, self.values = folder, bits, names, values
        self.maps: dict[tuple[int, str], np.ndarray] = {}

    def __reduce__(self):
        return Store, (self.folder, self.bits, self.names, self.values)

    def __len__(self) -> int:
        return sum(n for _, n in self.names.values())

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For ascending keys: the place of each in its shard (-1 where it is missing), and the
        values (0 where it is)."""
        place = np.full(len(keys), -1)
        out = [np.zeros(len(keys), np.int64) for _ in self.values]
        edges = np.searchsorted(shard_of(keys, self.bits), np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            if s not in self.names:
                continue
            stored = self.column(s, "keys")
            part = slice(edges[s], edges[s + 1])
            i = np.minimum(np.searchsorted(stored, keys[part]), len(stored) - 1)
            hit = stored[i] == keys[part]
            place[part] = np.where(hit, i, -1)
            for to, name in zip(out, self.values):
                to[part] = np.where(hit, self.column(s, name)[i], 0)
        return place, out

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys (in any order) are there."""
        distinct, inverse = np.unique(keys, return_inverse=True)
        return (self.get(distinct)[0] >= 0)[inverse]

    def look_up(self, keys: np.ndarray) -> list[np.ndarray]:
        """Values of keys in any order."""
        distinct, inverse = np.unique(keys, return_inverse=True)
        return [v[inverse] for v in self.get(distinct)[1]]

    def column(self, shard: int, name: str) -> np.ndarray:
        if (shard, name) not in self.maps:
            file, n = self.names[shard]
            self.maps[shard, name] = files.mapped(f"{self.folder}/{file}.{name}", n)
        return self.maps[shard, name]


LISTED = "shard int, file string, n long"


def save(folder: str, shard: int, keys: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """Write one shard; the row that lists it."""
    name = files.attempt_name(f"{shard:06d}")
    files.write(f"{folder}/{name}.keys", keys.astype("<u8").tobytes())
    for column, v in values.items():
        files.write(f"{folder}/{name}.{column}", _small(v)[1:])
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(keys)], pa.int64())], ["shard", "file", "n"])


def opened(spark: SparkSession, folder: str, listed: DataFrame, values: tuple[str, ...] = ()) -> Store:
    """The store that the listed rows (``LISTED``, at most one per shard) make up."""
    rows = listed.select("shard", "file", "n").collect()
    return Store(folder, shard_bits(spark), {r.shard: (r.file, r.n) for r in rows if r.n}, values)


def build(keys: DataFrame, column: str, name: str) -> Store:
    """Store of the distinct values of a long column."""
    spark = keys.sparkSession
    bits, folder = shard_bits(spark), common.shared_folder(spark, name)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(bits)
        for batch in batches:
            yield from counter.add(batch.column(0).to_numpy().view(np.uint64))
        yield from counter.flush()

    listed = common.stored(shards(
        keys.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(pack, PACKED),
        lambda shard, k, _: iter([save(folder, shard, k)]), LISTED), name)
    return opened(spark, folder, listed)
