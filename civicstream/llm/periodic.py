"""Runs of periodic words in texts, found by multi-scale minimizers (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that
holds at least ``max(LEAST, TIMES * q)`` words and that no neighbouring word extends.

* Periods up to ``DIRECT`` are found by scanning each lag: word i against word i + q.
* Scale K (a power of two) finds the periods in (K/2, K]. Its seeds are grams of K words that are
  the least of a window of K/2 grams by a mixed order (the leftmost of equal ones). Inside a run
  the window one period later has the same content, so it selects the gram one period later. A
  gram of at least q words can recur within the run only at multiples of q, so that gram is the
  next equal one selected: consecutive equal minimizers give the period.
* Seeds of the same lag that overlap are joined and extended both ways. Grams of 1, 2, 4, ... words
  carry names that are equal exactly where the words are, so an extension leaps by powers of two.
* A stretch found at a multiple of its period has the same borders as the one of its smallest
  period, which is kept.

Names are made by doubling, only for grams that recur in their text, so a text without repetition
costs little beyond its words. The work is one pass over the texts, without a shuffle.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and no runs. Repeated rows are
handled each; other columns are kept; of columns named like a result, the result replaces them. A
text is handled in one task whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, textscan

#: A run has at least this many words, and at least this many times its period.
LEAST, TIMES = 6, 4
#: Periods up to this one are found by direct lag scans; scales cover the longer ones.
DIRECT = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _named(keys: np.ndarray) -> np.ndarray:
    """Numbers of the keys that occur more than once; -1 for the others."""
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[name] > 1, name, -1)


def _doubled(name: np.ndarray, half: int) -> np.ndarray:
    """Names of the grams of twice ``half`` words from the names of those of ``half`` words."""
    out = np.full(len(name), -1)
    at = np.flatnonzero((name[:-half - 1] >= 0) & (name[half:-1] >= 0))
    if len(at):
        out[at] = _named(name[at] * np.int64(len(name)) + name[at + half])
    return out


def _minimizers(name: np.ndarray, width: int) -> np.ndarray:
    """Positions of the named grams that are the leftmost least of a window of ``width`` grams."""
    order = textscan.mix(name.astype(np.uint64))
    order[name < 0] = np.uint64(2**64 - 1)
    best = np.arange(len(name))
    reach = 1
    while reach < width:
        left, right = best[:-reach], best[reach:]
        best = np.where(order[left] <= order[right], left, right)
        reach *= 2
    best = np.unique(best)
    return best[name[best] >= 0]


def _seeds(name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and lag of consecutive equal minimizers of the scale ``size``."""
    at = _minimizers(name, size // 2)
    at = at[np.argsort(name[at], kind="stable")]
    lag = np.diff(at)
    good = (name[at[1:]] == name[at[:-1]]) & (lag > size // 2) & (lag <= size)
    return at[:-1][good], lag[good]


def _extended(levels: list[np.ndarray], start: np.ndarray, end: np.ndarray, lag: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """The whole stretch of positions whose word equals the one ``lag`` later around each range."""
    n = len(levels[0]) - 1
    start, end = start.copy(), end.copy()

    def leap(at, step, level):
        """Which ranges go on by the gram of this level from ``at``."""
        inside = (at >= 0) & (at + lag < n)
        a = np.where(inside, at, n)
        b = np.where(inside, at + lag, n)
        go = inside & (levels[level][a] >= 0) & (levels[level][a] == levels[level][b])
        return go, np.where(go, step, 0)

    top = len(levels) - 1
    for level in range(top, -1, -1):
        size = 1 << level
        while True:
            right, by = leap(end, size, level)
            end += by
            left, by = leap(start - size, size, level)
            start -= by
            if level < top or not (right.any() or left.any()):
                break
    return start, end


def find(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start, then period. ``words`` are numbers of words,
    ``owner`` the ascending number of the text that holds each."""
    n = len(words)
    empty = np.empty(0, np.int64)
    if n < LEAST:
        return empty, empty, empty
    _, name = np.unique(words, return_inverse=True)
    levels = [np.append(_named(owner * np.int64(n + 1) + name), -1)]      # a last place without a word
    longest = int(np.bincount(owner).max())
    start, length, period = [], [], []
    for q in range(1, min(DIRECT, n - 1) + 1):
        same = np.zeros(n + 1, bool)
        same[1:n - q + 1] = (levels[0][:n - q] >= 0) & (levels[0][:n - q] == levels[0][q:n])
        edges = np.flatnonzero(np.diff(same, append=False))
        a, b = edges[::2], edges[1::2]
        start.append(a)
        length.append(b - a + q)
        period.append(np.full(len(a), q))
    size = 1
    while TIMES * (max(size, DIRECT) + 1) <= longest and (levels[-1] >= 0).any():
        levels.append(_doubled(levels[-1], size))
        size *= 2
        if size <= DIRECT:
            continue
        at, lag = _seeds(levels[-1][:n], size)
        if not len(at):
            continue
        order = np.lexsort((at, lag, owner[at]))
        at, lag = at[order], lag[order]
        new = np.ones(len(at), bool)
        new[1:] = (lag[1:] != lag[:-1]) | (owner[at[1:]] != owner[at[:-1]]) | (at[1:] > at[:-1] + size)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        a, b = _extended(levels, at[first], at[last] + size, lag[first])
        start.append(a)
        length.append(b - a + lag[first])
        period.append(lag[first])
    start, length, period = (np.concatenate(x).astype(np.int64) for x in (start, length, period))
    good = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def planted(doc_ids: list, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(number of the text, a, p) of the texts whose words from a on repeat with period p: those
    whose crc32 of the decimal id divides by ten. A null id has none."""
    for i, doc in enumerate(doc_ids):
        n = int(counts[i])
        if doc is None or not n:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            yield i, a, 1 + (n - a) // (3 + g % 8)


Rewrite = Callable[[list, np.ndarray], Iterator[tuple[int, int, int]]]


def _analysed(column: pa.Array, keys: list, rewrite: Rewrite | None):
    """Runs (as an Arrow column of lists) and collapsed texts of a column of texts."""
    buf, offsets = common.text_buffer(column)
    start, end, owner = textscan.spans(buf, offsets, textscan.NOT_SPACE)
    counts = textscan.counts_of(owner, len(column))
    begins = np.cumsum(counts) - counts
    word = np.arange(len(start))
    for i, a, p in (rewrite(keys, counts) if rewrite else ()):
        lo, hi = begins[i] + a, begins[i] + counts[i]
        word[lo:hi] = lo + (np.arange(hi - lo) % p)
    number, _ = textscan.names(buf, start, end)
    s, length, period = find(number[word], owner)
    # words covered by a run behind its first period
    change = np.zeros(len(start) + 1, np.int64)
    np.add.at(change, s + period, 1)
    np.add.at(change, s + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    # kept words, each after the first of its text led by a space
    lead = np.zeros(len(kept), np.int64)
    lead[1:] = owner[kept[1:]] == owner[kept[:-1]]
    size = (end - start)[word[kept]]
    to = np.cumsum(size + lead) - size
    out = np.full(int((size + lead).sum()), 32, np.uint8)
    out[common.ragged(to, size)] = buf[common.ragged(start[word[kept]], size)]
    per_text = np.bincount(owner[kept], weights=size + lead, minlength=len(column)).astype(np.int64)
    collapsed = common.binary_column(out, np.concatenate([[0], np.cumsum(per_text)]))
    of = owner[s]
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(textscan.counts_of(of, len(column)))]).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(s - begins[of]), pa.array(length), pa.array(period)],
                                   ["start", "length", "period"]))
    return lists, collapsed


def annotate(docs: DataFrame, text: str = "text", key: str = "doc_id", rewrite: Rewrite | None = None) -> DataFrame:
    """``docs`` without its texts, with ``runs`` (by start, then period) and ``collapsed`` (UTF-8: the
    words that no run covers behind its first period, joined by one space). ``rewrite`` may replace
    words before the search (``planted``)."""
    common.require(docs, text, key)
    others = [c for c in docs.columns if c not in (text, "runs", "collapsed")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, text):
                found, collapsed = _analysed(part.column(text), part.column(key).to_pylist(), rewrite)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), found, collapsed],
                                                 [*others, "runs", "collapsed"])

    return docs.select(*others, common.utf8_text(text).alias(text)).mapInArrow(
        run, common.schema_of(docs, others, f"runs {RUNS}, collapsed binary"))


def _longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones the first by start, then by period."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return F.struct((-best.start).alias("start"), best.length.alias("length"), (-best.period).alias("period"))


def digest(docs: DataFrame) -> DataFrame:
    """Runs of every text after the planted repetitions; digests of all runs and of what is kept."""
    common.prepare(docs.sparkSession)
    found = annotate(docs.select("doc_id", "text"), rewrite=planted)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    best = _longest(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"),
        best.length.alias("length"), best.period.alias("period"),
        ((1000 * best.length - F.pmod(1000 * best.length, best.period)) / best.period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
