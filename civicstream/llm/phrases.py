"""Phrases whose words belong together, mined by partitions of the corpus (operator 13).

SON in two rounds, every count made by Spark:

* Documents are dealt into ``SHARDS`` shards by a hash. A phrase that occurs ``SUPPORT`` times in a
  language occurs in some shard at least ``SUPPORT`` times the shard's part of the language's words,
  so each shard is mined completely at that lower support, one length after another: a phrase is
  counted only where both phrases that are shorter by a word are frequent in the shard. Counts are
  packed keys (``hashstore``): 48 bits of the phrase's hash, 13 of its language's and 3 for the
  shard. Keys that collide only add candidates.
* The union of what is frequent in a shard is the candidate set. Every occurrence of a candidate in
  the corpus is counted, by the phrase itself and not by its hash, so the counts are exact.

The number of shards is fixed, so the lowered support (SUPPORT / SHARDS of an even deal) and with it
the share of phrases that reach the second round do not depend on the size of the corpus. Neither a
task nor the driver holds a shard: its counts are spread over files by their hash.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words
``[^\\x20\\x09]+``. A null text has no words, a null language is ``und``. Repeated rows count each;
other columns are ignored. Equal scores are ordered by count, then by the phrase's UTF-8 bytes. An
empty table has no phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicstream.llm import common, hashstore, textscan

U64 = np.uint64
#: Least number of occurrences, and most words, of a phrase.
SUPPORT, LONGEST = 30, 4
#: A candidate goes if a longer one holds it with at least this share of its occurrences.
PERCENT = 80
#: Phrases returned for each language, and the scale of the score.
TOP, SCALE = 2000, 2_000_000
#: Shards of the corpus (three bits of a key).
SHARDS = 8
#: Bits of a key that tell language and shard, and buckets of languages.
GROUP_BITS, BUCKETS = 16, 1 << 13

#: Bytes of words, and those that end a piece.
_WORD = np.ones(256, bool)
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[0x0A:0x0E] = True
_WORD[[0x20, 0x09]] = _WORD[_BREAK] = False

GROUP = U64((1 << GROUP_BITS) - 1)
IN_BUCKET = U64(SHARDS - 1)


class Words:
    """The words of many texts: hash, piece, and group (bucket of the language and shard)."""

    def __init__(self, part: pa.RecordBatch):
        buf, offsets = common.text_buffer(part.column("text"))
        self.buf = textscan.LOWER[buf]
        self.start, self.end, self.owner = textscan.spans(self.buf, offsets, _WORD)
        ended = np.cumsum(_BREAK[self.buf])
        before = ended[self.start] if len(self.start) else np.empty(0, np.int64)
        new = np.ones(len(self.start), bool)
        new[1:] = (before[1:] != before[:-1]) | (self.owner[1:] != self.owner[:-1])
        self.piece = np.cumsum(new)
        self.langs = part.column("lang").to_pylist()
        bucket = np.array([zlib.crc32(x.encode()) % BUCKETS for x in self.langs], np.int64)
        group = bucket * SHARDS + part.column("shard").to_numpy(zero_copy_only=False).astype(np.int64)
        self.group = group[self.owner].astype(U64)
        salt = {x: U64(zlib.crc32(x.encode())) << U64(32) for x in set(self.langs)}
        self.salt = np.array([salt[x] for x in self.langs], U64)[self.owner]

    def __len__(self) -> int:
        return len(self.start)

    def keys(self, size: int, at: np.ndarray) -> np.ndarray:
        """Keys of the phrases of ``size`` words that begin at these words."""
        h = self.hashes()[at]
        for j in range(1, size):
            h = textscan.mix(h * U64(0x9E3779B97F4A7C15) + self.hashes()[at + j])
        return textscan.mix(h ^ self.salt[at]) & ~GROUP | self.group[at]

    def hashes(self) -> np.ndarray:
        if not hasattr(self, "_hashes"):
            self._hashes = textscan.word_hash(self.buf, self.start, self.end)
        return self._hashes

    def places(self, size: int) -> np.ndarray:
        """Words at which a phrase of ``size`` words begins."""
        if len(self) < size:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[:len(self) - size + 1] == self.piece[size - 1:])

    def frequent(self, local: list[hashstore.Store], size: int) -> np.ndarray:
        """Places of phrases whose two phrases shorter by a word are frequent in the shard."""
        at = self.places(size)
        if size == 1 or not len(at):
            return at
        good = np.zeros(len(self) + 1, bool)
        good[at] = good[at + 1] = True
        shorter = np.flatnonzero(good)
        good[shorter] = local[size - 2].has(self.keys(size - 1, shorter))
        return at[good[at] & good[at + 1]]


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(common.utf8_text("text"), F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).cast("int").alias("shard"))


def _word_counts(texts: DataFrame) -> DataFrame:
    """lang, shard, n: words of each language in each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                w = Words(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("shard"), pa.array(textscan.counts_of(w.owner, part.num_rows))],
                    ["lang", "shard", "n"])

    return texts.mapInArrow(run, "lang string, shard int, n long").groupBy("lang", "shard").agg(F.sum("n").alias("n"))


def _supports(counts: DataFrame, support: int) -> np.ndarray:
    """Local support of every group; the least one where languages share a bucket."""
    whole = counts.groupBy("lang").agg(F.sum("n").alias("whole"))
    part = F.col("n").cast("decimal(38,0)")
    lowered = F.greatest(F.lit(1), F.ceil(part * support / F.col("whole"))).cast("long")
    group = F.pmod(F.crc32(F.encode("lang", "UTF-8")), F.lit(BUCKETS)) * SHARDS + F.col("shard")
    rows = (counts.where("n > 0").join(whole, "lang").groupBy(group.cast("int").alias("g"))
            .agg(F.min(lowered).alias("least")).collect())                    # at most 2^16 groups
    out = np.ones(1 << GROUP_BITS, np.int64)
    for r in rows:
        out[r.g] = r.least
    return out


def _mined(texts: DataFrame, local: list[hashstore.Store], size: int, least: np.ndarray
           ) -> tuple[hashstore.Store, hashstore.Store]:
    """Stores of the phrases of ``size`` words that are frequent in a shard: by shard, and without
    the shard."""
    spark = texts.sparkSession
    bits = hashstore.shard_bits(spark)
    folder = common.shared_folder(spark, f"phrases-{size}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hashstore.Counter(bits)
        for batch in batches:
            for part in common.slices(batch, "text"):
                w = Words(part)
                yield from counter.add(w.keys(size, w.frequent(local, size)))
        yield from counter.flush()
        common.release()

    def keep(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = keys[counts >= least[(keys & GROUP).astype(np.int64)]]
        yield _listed(hashstore.save(folder, shard, keys), True)
        yield _listed(hashstore.save(folder, shard, np.unique(keys & ~IN_BUCKET)), False)

    listed = common.stored(hashstore.shards(texts.mapInArrow(count, hashstore.PACKED), keep,
                                            f"{hashstore.LISTED}, by_shard boolean"), f"phrases-{size}")
    return (hashstore.opened(spark, folder, listed.where("by_shard")),
            hashstore.opened(spark, folder, listed.where("not by_shard")))


def _listed(row: pa.RecordBatch, by_shard: bool) -> pa.RecordBatch:
    return row.append_column("by_shard", pa.array([by_shard]))


def _counted(texts: DataFrame, candidates: list[hashstore.Store]) -> DataFrame:
    """lang, phrase, words, f: exact numbers of occurrences of all candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text"):
                yield from _occurrences(Words(part), candidates)

    return (texts.mapInArrow(run, "lang string, phrase string, words int, f long")
            .groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")))


def _occurrences(w: Words, candidates: list[hashstore.Store]) -> Iterator[pa.RecordBatch]:
    if not len(w):
        return
    place = {x: i for i, x in enumerate(sorted(set(w.langs)))}
    lang = np.array([place[x] for x in w.langs], np.int64)[w.owner]
    word, _ = textscan.names(w.buf, w.start, w.end)
    n = np.int64(len(w) + 1)
    name = np.full(len(w), -1)                      # of the phrase of one word less, where it may go on
    for size in range(1, LONGEST + 1):
        at = w.places(size)
        if size > 1:
            at = at[name[at] >= 0]
        at = at[candidates[size - 1].has(w.keys(size, at) & ~IN_BUCKET)] if len(at) else at
        if not len(at):
            return
        codes = (lang[at] if size == 1 else name[at]) * n + word[at + size - 1]
        first, number, f = textscan.numbered(codes)
        name = np.full(len(w), -1)
        name[at] = number
        yield _rows(w, at[first], size, f)


def _rows(w: Words, at: np.ndarray, size: int, f: np.ndarray) -> pa.RecordBatch:
    """The phrases of ``size`` words at these words, joined by one space."""
    words = (at[:, None] + np.arange(size)).ravel()
    length = w.end[words] - w.start[words]
    room = length + 1
    room[::size] -= 1                               # no space before the first word
    to = np.cumsum(room) - length
    out = np.full(int(room.sum()), 32, np.uint8)
    out[common.ragged(to, length)] = w.buf[common.ragged(w.start[words], length)]
    ends = np.cumsum(room)[size - 1::size]
    text = common.binary_column(out, np.concatenate([[0], ends])).cast(pa.string())
    langs = pa.array([w.langs[i] for i in w.owner[at].tolist()], pa.string())
    return pa.RecordBatch.from_arrays(
        [langs, text, pa.array(np.full(len(at), size, np.int32)), pa.array(f.astype(np.int64))],
        ["lang", "phrase", "words", "f"])


def frequencies(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of one to four words with at least ``support``
    occurrences in its language, and (lang, n), the number of words of each language."""
    texts = _prepared(docs)
    counts = common.stored(_word_counts(texts), "word-counts")
    least = _supports(counts, support)
    local, union = [], []
    for size in range(1, LONGEST + 1):
        by_shard, whole = _mined(texts, local, size, least)
        local.append(by_shard)
        union.append(whole)
    found = _counted(texts, union).where(F.col("f") >= support)
    return common.stored(found, "phrases"), counts.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """The best phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score."""
    found, n = frequencies(docs, support)
    candidate = found.where("words > 1").withColumnRenamed("f", "a")
    # what a longer candidate holds; a word count tells how many words a part has
    inner = reduce(DataFrame.unionByName, [
        candidate.where(F.col("words") > size).select(
            "lang", F.col("a").alias("longer"), F.explode(F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda i: F.array_join(F.slice(F.split("phrase", " "), i, size), " "))).alias("phrase"))
        for size in range(2, LONGEST)])
    covered = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = (candidate.join(covered, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * PERCENT))
            .drop("longer"))
    cuts = free.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"),
                           F.array_join(F.slice(F.split("phrase", " "), 1, k), " ").alias("first"),
                           F.array_join(F.slice(F.split("phrase", " "), k + 1, LONGEST), " ").alias("rest"))))
        .alias("cut")).select("lang", "phrase", "a", "cut.*")
    parts = found.select("lang", F.col("phrase").alias("part"), "f")
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    score = F.expr(f"(cast(a as decimal(38,0)) * {SCALE}) div (cast(l as decimal(38,0)) + r)").cast("long")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
              .select("lang", "phrase", "best.a", "best.l", "best.r", "best.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(common.partitions(docs.sparkSession)))
    near = (scored.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .where(F.col("rank") <= top))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame) -> DataFrame:
    common.prepare(docs.sparkSession)
    return collocations(docs.select("doc_id", "lang", "text"))
