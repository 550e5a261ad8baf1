"""Toxicity scores by a factorization machine over hashed terms (operator 4).

Terms of a text are its distinct lower-cased words and their prefixes of several lengths, as
64-bit hashes. The machine scores

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms i, j that a text has, through the logistic function, so a pair of terms can count
for more (or less) than both alone, such as an insult next to the mention of a group.

It is fitted on a bounded sample of labelled documents (``SAMPLE``, those with the smallest
hashes of their ids). Spark counts in how many of them each term occurs by label; the
``TERMS`` terms that tell most about the label (likelihood-ratio statistic) become features. The
feature lists of the sample, bounded likewise, are fitted on the driver by Adagrad. Scoring is
one pass without a shuffle; every text is read whole.

Null and empty texts have no terms and score the intercept. Null labels are not learned from; a
document that any row labels toxic is toxic. Without training rows, or with one label only, the
share of toxic labels is the score (about 0 without rows). Repeated rows are scored each. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, hashstore, textscan

U64 = np.uint64
#: Labelled documents that the machine is fitted on, and terms it knows, at most.
SAMPLE, TERMS = 20_000, 4096
#: Fewest sample documents of a term; prefix lengths in bytes.
LEAST_DOCS, PREFIXES = 4, (4, 5, 6, 7, 8)
FACTORS, EPOCHS, BATCH, RATE, L2 = 8, 30, 256, 0.1, 1e-4

_SALT = U64(0x5851F42D4C957F2D)


class Terms:
    """Words of some texts with the hashes of their terms."""

    def __init__(self, column: pa.Array):
        buf, offsets = common.text_buffer(column)
        buf = textscan.LOWER[buf]
        start, end, self.owner = textscan.spans(buf, offsets, textscan.ALNUM)
        sums = textscan.prefix_sums(buf)
        h = textscan.span_hash(sums, start, end)
        word, first, self.inverse = np.unique(h, return_index=True, return_inverse=True)
        start, end = start[first], end[first]
        kinds = [word & ~U64(1)]
        for n in PREFIXES:
            cut = np.minimum(start + n, end)
            kinds.append(textscan.mix(textscan.span_hash(sums, start, cut) + _SALT) & ~U64(1))
        #: terms of each distinct word; the lowest bit is left to the label when they are counted
        self.hashes = np.stack(kinds, 1) if len(word) else np.empty((0, 1 + len(PREFIXES)), U64)

    def of_texts(self, n: int) -> Iterator[np.ndarray]:
        """Distinct terms of each text."""
        edges = np.searchsorted(self.owner, np.arange(n + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            yield np.unique(self.hashes[np.unique(self.inverse[a:b])])

    def features(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs, once each, of the ascending known terms."""
        if not len(known) or not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(known, self.hashes), len(known) - 1)
        word, kind = np.nonzero(known[at] == self.hashes)
        count = np.bincount(word, minlength=len(self.hashes))
        begin = np.cumsum(count) - count
        token = np.flatnonzero(count[self.inverse])
        w = self.inverse[token]
        feature = at[word, kind][common.ragged(begin[w], count[w])]
        pair = np.unique(np.repeat(self.owner[token], count[w]) * len(known) + feature)
        return pair // len(known), pair % len(known)


class Machine:
    def __init__(self, known: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.known, self.w0, self.w, self.v = known, w0, w, v

    def score(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        text, feature = Terms(column).features(self.known)
        return _logistic(_margin(self.w0, self.w, self.v, text, feature, n)[0])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _margin(w0, w, v, text, feature, n):
    """Scores of n texts, and their sums of factors."""
    linear = np.bincount(text, w[feature], n)
    sums = np.stack([np.bincount(text, v[feature, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(text, (v[feature] ** 2).sum(1), n)
    return w0 + linear + 0.5 * ((sums ** 2).sum(1) - squares), sums


def train(known: np.ndarray, labels: np.ndarray, rows: list[np.ndarray]) -> Machine:
    """Fit on feature lists and 0/1 labels."""
    share = labels.mean() if len(labels) else 0.0
    rng = np.random.Generator(np.random.PCG64(3))
    w, v = np.zeros(len(known)), rng.normal(0, 0.01, (len(known), FACTORS))
    if share in (0.0, 1.0) or not len(known):
        return Machine(known, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), w, v)
    w0 = float(np.log(share / (1 - share)))
    g0, gw, gv = 1e-8, np.full(len(known), 1e-8), np.full(v.shape, 1e-8)
    count = np.array([len(r) for r in rows])
    flat = np.concatenate(rows)
    begin = np.cumsum(count) - count
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            own = order[i:i + BATCH]
            feature = flat[common.ragged(begin[own], count[own])]
            text = np.repeat(np.arange(len(own)), count[own])
            margin, sums = _margin(w0, w, v, text, feature, len(own))
            error = (_logistic(margin) - labels[own]) / len(own)
            d0 = error.sum()
            g0 += d0 * d0
            w0 -= RATE * d0 / np.sqrt(g0)
            used, at = np.unique(feature, return_inverse=True)
            if not len(used):
                continue
            dw = np.bincount(at, error[text], len(used)) + L2 * w[used]
            per = error[text, None] * (sums[text] - v[feature])
            dv = np.stack([np.bincount(at, per[:, f], len(used)) for f in range(FACTORS)], 1) + L2 * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * dv / np.sqrt(gv[used])
    return Machine(known, w0, w, v)


def _ratio(k1: np.ndarray, k0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Likelihood-ratio statistic of a term in k1 of n1 and k0 of n0 texts."""
    def part(k, n, p):
        return k * np.log(np.maximum(p, 1e-12)) + (n - k) * np.log(np.maximum(1 - p, 1e-12))

    both = (k1 + k0) / (n1 + n0)
    return 2 * (part(k1, n1, k1 / n1) + part(k0, n0, k0 / n0) - part(k1, n1, both) - part(k0, n0, both))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Machine:
    """Fit on the labelled documents of ``docs``; see ``SAMPLE``."""
    spark = common.prepare(docs.sparkSession)
    bits = hashstore.shard_bits(spark)
    key = F.xxhash64(F.col(id_col).cast("string"))
    marked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label")))
    found = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), key.alias("_key"))
    last = found.join(marked, "_id").select("_key").orderBy("_key").limit(SAMPLE).agg(F.max("_key")).head()[0]
    none = np.empty(0, U64)
    if last is None:
        return train(none, np.empty(0), [])
    sample = common.stored(
        docs.where(key <= last).select(F.col(id_col).alias("_id"), key.alias("_key"),
                                       common.utf8_text(text_col).alias("_text"))
        .join(marked, "_id").orderBy("_key").limit(SAMPLE).select("_text", "_label"), "sample")
    n1 = sample.where("_label = 1").count()
    n0 = sample.count() - n1
    if not n1 or not n0:
        return train(none, np.array([1.0] if n1 else [0.0]), [np.empty(0, np.int64)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hashstore.Counter(bits)
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                label = rows.column("_label").to_pylist()
                for y, terms in zip(label, Terms(rows.column("_text")).of_texts(rows.num_rows)):
                    yield from counter.add(terms | U64(y))
        yield from counter.flush()

    def choose(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        term, at = np.unique(keys & ~U64(1), return_inverse=True)
        toxic = (keys & U64(1)).astype(bool)
        k1 = np.bincount(at, np.where(toxic, counts, 0), len(term))
        k0 = np.bincount(at, np.where(toxic, 0, counts), len(term))
        often = k1 + k0 >= LEAST_DOCS
        term, value = term[often], _ratio(k1[often], k0[often], n1, n0)
        top = np.lexsort((term, -value))[:TERMS]
        yield pa.RecordBatch.from_arrays([pa.array(term[top].view(np.int64)), pa.array(value[top])],
                                         ["term", "value"])

    scored = hashstore.shards(sample.mapInArrow(count, hashstore.PACKED), choose, "term long, value double")
    best = scored.orderBy(F.desc("value"), "term").limit(TERMS).collect()
    known = np.sort(np.array([r.term for r in best], np.int64).view(U64))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                text, feature = Terms(rows.column("_text")).features(known)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=rows.num_rows))])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_label"), common.binary_column(feature.astype("<u2"), ends * 2)],
                    ["label", "features"])

    rows = sample.mapInArrow(features, "label int, features binary").orderBy("features", "label").collect()
    return train(known, np.array([r.label for r in rows], float),
                 [np.frombuffer(r.features, "<u2").astype(np.int64) for r in rows])


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with score (0 to 1) and predicted (1 from 0.5 on)."""
    common.require(docs, text_col)
    keep = [c for c in docs.columns if c not in (text_col, "score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                s = machine.score(rows.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    [*keep, "score", "predicted"])

    source = docs.select(*keep, common.utf8_text(text_col).alias("_text"))
    return source.mapInArrow(run, common.schema_of(source, keep, "score double, predicted int"))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents that are not held out, score all."""
    machine = fit(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), machine)
