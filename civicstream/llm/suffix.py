"""Repeated byte strings by a difference-cover sample of suffixes (operator 6).

All suffixes of all texts are compared up to ``length`` bytes. As in the difference-cover
construction, only the suffixes that begin at positions of a difference cover modulo V are
sampled: for any two positions i, j of any two texts there is a shift below V that brings both
into the sample. So two equal strings of ``length`` bytes contain, at one shift, two sampled
suffixes that are equal over their first ``length - V + 1`` bytes.

1. Sampled suffixes are named by the hash of those bytes, and the names are sorted, in shards;
   names that occur once leave (nothing that needs them is repeated).
2. The suffixes that a repeated name reaches back to, sampled or not, are merged in: they are
   named by the hash of their full ``length`` bytes. Equal neighbours in the sorted order have a
   common prefix of at least ``length``: such names stay.
3. Every text looks its suffixes up and removes the bytes that the found ones cover.

Sorted names are files of ascending 64-bit hashes in the shared folder (``hashstore``), so tasks
map what they touch, and no text is shuffled. Strings are judged on the input as it is; matches
never cross texts; an occurrence may overlap the other.

Null text is empty: nothing to remove. Texts shorter than ``length`` are kept whole. Repeated
rows are copies of each other. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, hashstore, textscan

LENGTH = 200


@functools.cache
def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """Modulus V = q * q + q + 1 (q prime, V at most two thirds of ``length``, so that names
    cover the rest) and a perfect difference set modulo V of q + 1 members.

    The members are where a recurrence of order three over the integers modulo q is zero; the
    recurrences are tried until the differences of the members are all residues.
    """
    primes = [q for q in range(2, int(length ** 0.5) + 1) if all(q % d for d in range(2, q))
              and 3 * (q * q + q + 1) <= 2 * length + 2]
    if not primes:
        return 1, (0,)
    q = primes[-1]
    v = q * q + q + 1
    for a, b, c in itertools.product(range(q), range(q), range(1, q)):
        s = [0, 0, 1]
        while len(s) < v:
            s.append((a * s[-1] + b * s[-2] + c * s[-3]) % q)
        members = [i for i in range(v) if s[i] == 0]
        if len(members) == q + 1 and len({(x - y) % v for x in members for y in members}) == v:
            return v, tuple(members)
    raise AssertionError(f"no difference set modulo {v}")


class _Slice:
    """Hashes of the suffixes of some texts."""

    def __init__(self, column: pa.Array, length: int):
        self.buf, self.offsets = common.text_buffer(column)
        self.length = length
        self.sums = textscan.prefix_sums(self.buf)

    def names(self, at: np.ndarray, size: int) -> np.ndarray:
        return textscan.span_hash(self.sums, at, at + size)

    def sampled(self) -> np.ndarray:
        """Positions of the sampled suffixes that a string of ``length`` bytes can contain."""
        v, cover = difference_cover(self.length)
        sizes = np.diff(self.offsets)
        long = np.flatnonzero(sizes >= self.length)
        if not len(long):
            return np.empty(0, np.int64)
        last = sizes[long] - (self.length - v + 1)           # the last begin of a whole name
        blocks = last // v + 1
        base = common.ragged(np.zeros(len(long), np.int64), blocks) * v
        text = np.repeat(np.arange(len(long)), blocks)
        at = (base[:, None] + np.array(cover)).ravel()
        text = np.repeat(text, len(cover))
        good = at <= last[text]
        return self.offsets[long][text[good]] + at[good]

    def candidates(self, anchors: np.ndarray) -> np.ndarray:
        """Begins of the strings of ``length`` bytes that contain the name at an anchor."""
        v, _ = difference_cover(self.length)
        n = len(self.buf)
        text = np.searchsorted(self.offsets, anchors, side="right") - 1
        lo = np.maximum(anchors - v + 1, self.offsets[text])
        hi = np.minimum(anchors, self.offsets[text + 1] - self.length) + 1
        good = lo < hi
        edge = np.bincount(lo[good], minlength=n + 1) - np.bincount(hi[good], minlength=n + 1)
        return np.flatnonzero(np.cumsum(edge) > 0)

    def covered(self, begins: np.ndarray) -> np.ndarray:
        """Which bytes lie in the strings that begin there."""
        n = len(self.buf)
        edge = np.bincount(begins, minlength=n + 1) - np.bincount(begins + self.length, minlength=n + 1)
        return np.cumsum(edge)[:n] > 0


def _repeated(keys: DataFrame, name: str) -> hashstore.Store:
    """Store of the keys that were counted twice or more."""
    spark = keys.sparkSession
    folder = common.shared_folder(spark, name)

    def keep(shard: int, k: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield hashstore.save(folder, shard, k[counts > 1])

    listed = common.stored(hashstore.shards(keys, keep, hashstore.LISTED), name)
    return hashstore.opened(spark, folder, listed)


def repeated_suffixes(docs: DataFrame, text_col: str = "text", length: int = LENGTH
                      ) -> tuple[hashstore.Store, hashstore.Store]:
    """The repeated names of sampled suffixes, and of all suffixes over ``length`` bytes."""
    spark = common.prepare(docs.sparkSession)
    bits = hashstore.shard_bits(spark)
    texts = docs.select(common.utf8_text(text_col).alias("_text"))
    short = length - difference_cover(length)[0] + 1

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hashstore.Counter(bits)
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                s = _Slice(rows.column("_text"), length)
                yield from counter.add(s.names(s.sampled(), short))
        yield from counter.flush()

    anchors = _repeated(texts.mapInArrow(sample, hashstore.PACKED), "anchors")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hashstore.Counter(bits)
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                s = _Slice(rows.column("_text"), length)
                at = s.sampled()
                at = s.candidates(at[anchors.has(s.names(at, short))])
                yield from counter.add(s.names(at, length))
        yield from counter.flush()

    return anchors, _repeated(texts.mapInArrow(merge, hashstore.PACKED), "suffixes")


def remove_repeated(docs: DataFrame, text_col: str = "text", length: int = LENGTH,
                    bytes_col: str = "kept_bytes") -> DataFrame:
    """``docs`` without ``text_col``, with n_bytes, n_removed, n_spans (maximal removed runs) and
    ``bytes_col``, the remaining bytes (which may begin or end within a character)."""
    common.require(docs, text_col)
    anchors, strings = repeated_suffixes(docs, text_col, length)
    made = ["n_bytes", "n_removed", "n_spans", bytes_col]
    keep = [c for c in docs.columns if c != text_col and c not in made]
    short = length - difference_cover(length)[0] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                s = _Slice(rows.column("_text"), length)
                at = s.sampled()
                at = s.candidates(at[anchors.has(s.names(at, short))])
                gone = s.covered(at[strings.has(s.names(at, length))])
                total = np.concatenate([[0], np.cumsum(gone)])
                start = gone.copy()
                start[1:] &= ~gone[:-1] | np.isin(np.arange(1, len(gone)), s.offsets)
                spans = np.concatenate([[0], np.cumsum(start)])
                removed = total[s.offsets]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), pa.array(np.diff(s.offsets)), pa.array(np.diff(removed)),
                     pa.array(np.diff(spans[s.offsets])),
                     common.binary_column(s.buf[~gone], s.offsets - removed)], [*keep, *made])

    source = docs.select(*keep, common.utf8_text(text_col).alias("_text"))
    return source.mapInArrow(run, common.schema_of(
        source, keep, f"n_bytes long, n_removed long, n_spans long, `{bytes_col}` binary"))


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeated(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
