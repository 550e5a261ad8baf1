"""Benchmark decontamination by winnowing (operator 3).

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A benchmark item
has the windows of ``window`` consecutive words; a shorter item is one window by itself.

A document keeps, of every ``window - k + 1`` consecutive k-gram hashes, the smallest (leftmost
of equals). An item window keeps the same one of its own, so a shared window always shares a
fingerprint. Fingerprints of documents that cannot be a benchmark fingerprint are dropped by a
bit table of fixed size; the others are joined with the benchmark's, and the hits are extended
to whole windows and compared. Windows of short items are looked up whole, at every word.

Null text has no words; so has text without letters and digits: no hits. Repeated rows are
reported each. Items without words never occur; rows of one item id are one item; a null item
id is written as the empty string. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicstream.llm import common, textscan

WINDOW = 10
K = 4

#: Bits of the table that sorts out document fingerprints before the shuffle (1 MB, whatever the
#: benchmark's size; a fuller table lets more fingerprints through to the join).
BITS = 1 << 23

HITS = "hits array<struct<fp:long,pos:int,len:int,grams:array<long>>>"
_HIT = pa.struct([("fp", pa.int64()), ("pos", pa.int32()), ("len", pa.int32()),
                  ("grams", pa.list_(pa.int64()))])


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    buf, offsets = common.text_buffer(column)
    buf = textscan.LOWER[buf]
    start, end, owner = textscan.spans(buf, offsets, textscan.ALNUM)
    return textscan.span_hash(textscan.prefix_sums(buf), start, end), owner


def _whole(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words that also tell n."""
    g, first = textscan.grams(h, owner, n)
    return textscan.mix(g + textscan.U64(n)), first


def _smallest(h: np.ndarray, owner: np.ndarray, window: int, k: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of words: its first word, the word of its smallest k-gram (leftmost of
    equals) and that hash."""
    g, first = textscan.grams(h, owner, k)
    if not len(g):
        return first, first, g
    full = np.full(len(h), np.iinfo(np.uint64).max, np.uint64)
    full[first] = g
    n = len(h) - window + 1
    if n <= 0:
        return first[:0], first[:0], g[:0]
    best, at = full[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window - k + 1):
        less = full[j:n + j] < best
        best[less] = full[j:n + j][less]
        at[less] = j
    start = np.flatnonzero(owner[:n] == owner[window - 1:])
    return start, start + at[start], best[start]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW, k: int = K) -> DataFrame:
    """item, len, gram (hash of the whole window), fp, at (word of the fingerprint in it)."""
    common.require(items, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "text"):
                h, owner = _words(rows.column("text"))
                sizes = textscan.counts_of(owner, rows.num_rows)
                out = []
                start, at, fp = _smallest(h, owner, window, k)
                gram, first = _whole(h, owner, window)
                out.append((owner[first], np.full(len(first), window), gram, fp, at - start))
                for n in range(1, window):
                    gram, first = _whole(h, owner, n)
                    mine = sizes[owner[first]] == n
                    gram, first = gram[mine], first[mine]
                    out.append((owner[first], np.full(len(first), n), gram, gram, np.zeros(len(first))))
                row, size, gram, fp, at = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("item").take(pa.array(row)), pa.array(size.astype(np.int32)),
                     pa.array(gram.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(at.astype(np.int32))],
                    ["item", "len", "gram", "fp", "at"])

    return (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                         common.utf8_text(text_col).alias("text"))
            .mapInArrow(run, "item string, len int, gram long, fp long, at int").distinct())


def _bit_table(windows: DataFrame) -> np.ndarray:
    """Bit table of the fingerprints; built in Spark, at most BITS / 64 rows come back."""
    slot = F.expr(f"pmod(fp, {BITS})")
    rows = (windows.select((slot / 64).cast("int").alias("word"),
                           F.expr(f"shiftleft(1L, cast(pmod(fp, 64) as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def _possible(table: np.ndarray, fp: np.ndarray) -> np.ndarray:
    slot = fp.view(np.int64) % BITS
    return (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def scan(docs: DataFrame, windows: DataFrame, keep: list[str], text_col: str = "text",
         window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: rid (unique), the ``keep`` columns, n_words, and the fingerprints
    that pass the bit table, each with the hashes of the whole windows around it."""
    spark = common.prepare(docs.sparkSession)
    table = spark.sparkContext.broadcast(_bit_table(windows))
    short = sorted(r["len"] for r in windows.where(F.col("len") < window).select("len").distinct().collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                n = rows.num_rows
                h, owner = _words(rows.column("_text"))
                sizes = textscan.counts_of(owner, n)
                begin = np.cumsum(sizes) - sizes
                found = []
                start, at, fp = _smallest(h, owner, window, k)
                new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.empty(0, bool)
                at, fp = at[new], fp[new]
                good = _possible(bits, fp)
                at, fp = at[good], fp[good]
                gram, first = _whole(h, owner, window)
                full, valid = np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
                full[first], valid[first] = gram, True
                around = at[:, None] - np.arange(window - k + 1)
                inside = (around >= 0) & valid[np.maximum(around, 0)] & (
                    owner[np.maximum(around, 0)] == owner[at][:, None])
                found.append((at, fp, np.full(len(at), window), full[np.maximum(around, 0)].ravel(),
                              ~inside.ravel(), np.full(len(at), window - k + 1)))
                for size in short:
                    gram, first = _whole(h, owner, size)
                    good = _possible(bits, gram)
                    gram, first = gram[good], first[good]
                    found.append((first, gram, np.full(len(first), size), gram, np.zeros(len(first), bool),
                                  np.ones(len(first), np.int64)))
                at, fp, size, grams, null, width = (np.concatenate(x) for x in zip(*found))
                ends = np.cumsum(width)
                order = np.argsort(owner[at], kind="stable")
                pick = common.ragged((ends - width)[order], width[order])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(width[order])]).astype(np.int32)),
                    pa.array(grams[pick].view(np.int64), mask=null[pick]))
                hits = pa.StructArray.from_arrays(
                    [pa.array(fp[order].view(np.int64)), pa.array((at - begin[owner[at]])[order].astype(np.int32)),
                     pa.array(size[order].astype(np.int32)), lists], fields=list(_HIT))
                per_row = np.concatenate([[0], np.cumsum(textscan.counts_of(owner[at], n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ["_rid", *keep]), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(per_row), hits)],
                    ["_rid", *keep, "_n_words", "hits"])

    source = docs.select(*keep, common.utf8_text(text_col).alias("_text"),
                         F.monotonically_increasing_id().alias("_rid"))
    kept = common.schema_of(source, keep, f"`_n_words` long, {HITS}")
    return common.stored(source.mapInArrow(run, f"`_rid` long, {kept}"), "fingerprints")


def occurrences(scanned: DataFrame, windows: DataFrame) -> DataFrame:
    """_rid, start, len, gram of every window occurrence in a document, once."""
    hits = scanned.select("_rid", F.inline("hits")).alias("h")
    wins = windows.select("fp", "at", "len", "gram").distinct().alias("w")
    return (hits.join(wins, (F.col("h.fp") == F.col("w.fp")) & (F.col("h.len") == F.col("w.len"))
                      & (F.expr("element_at(h.grams, w.at + 1)") == F.col("w.gram")))
            .select("_rid", F.expr("h.pos - w.at").alias("start"), "h.len", "w.gram").distinct())


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_hit (words inside an occurring window),
    n_items, item_ids (sorted as strings, comma-joined), contaminated."""
    common.require(docs, id_col, text_col)
    windows = common.stored(item_windows(items, text_col=text_col, window=window, k=k), "windows")
    scanned = scan(docs, windows, [id_col], text_col, window, k)
    found = common.stored(occurrences(scanned, windows), "occurrences")
    order = Window.partitionBy("_rid").orderBy("start")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    words = (found.groupBy("_rid", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
             .withColumn("from", F.greatest("start", F.coalesce(reached, F.lit(0))))
             .groupBy("_rid").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit")))
    named = (found.select("_rid", "len", "gram").distinct()
             .join(windows.select("item", "len", "gram").distinct(), ["len", "gram"])
             .groupBy("_rid").agg(F.sort_array(F.collect_set("item")).alias("found_items")))
    out = (scanned.select("_rid", F.col(id_col), F.col("_n_words").alias("n_words"))
           .join(words, "_rid", "left").join(named, "_rid", "left"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_of = F.coalesce("found_items", F.expr("cast(array() as array<string>)"))
    return out.select(id_col, "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.concat_ws(",", items_of).alias("item_ids"), (n_hit > 0).alias("contaminated"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return report(docs, items).select("doc_id", "n_words", "n_hit", "n_items",
                                      F.sha2("item_ids", 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a benchmark window, all columns unchanged."""
    key = [F.col(id_col).alias("_k0"), F.xxhash64(text_col).alias("_k1")]
    keyed = docs.select("*", *key)
    found = report(docs.select(F.struct(*key).alias("_key"), F.col(text_col)), items, "_key", text_col)
    bad = common.stored(found.where("contaminated").select("_key._k0", "_key._k1").distinct(), "contaminated")
    return (keyed.alias("d").join(bad.alias("b"), (F.col("d._k1") == F.col("b._k1"))
                                  & F.col("d._k0").eqNullSafe(F.col("b._k0")), "left_anti")
            .drop("_k0", "_k1"))
