"""Language of every word by a linear-chain conditional random field (operator 7).

A text is a chain of words (lower-cased runs of letters, digits and non-ASCII characters). A
word's features are itself, its prefixes and suffixes, its byte n-grams (all hashed into a table
of fixed size), and for each language whether the word is in that language's lexicon (words that
the sample has at least twice, nearly always in that language). Learned transitions between the
labels of neighbours let a text switch languages and keep single odd words from doing so.
Forward-backward gives each word a distribution over the languages; a text's score for a language
is the mean over its words with a letter.

The field is fitted on the driver from a bounded sample: ``SAMPLE`` documents, the languages
taking turns (within one, by a hash of the id), and ``SEGMENT`` words of each, from a place that
the hash tells. Training chains put two segments together, so that switches occur in them.
Prediction reads every text whole, in one pass without a shuffle, and bounded memory.

Null text, and text without a letter, is ``und`` with score 0; so is everything when there is
nothing to learn from. Null languages and null ids are not learned from. Repeated rows are
labelled each; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicstream.llm import common, textscan

U64 = np.uint64
SAMPLE, SEGMENT = 8000, 24
#: A language's ids are first cut within parts by hash, four times as many as a part of the sample needs.
PARTS = 64
#: Rows of the feature table; features of a word: affix lengths and n-gram lengths in bytes.
TABLE = 1 << 18
PREFIXES, SUFFIXES, GRAMS = (1, 2, 3), (1, 2, 3, 4), (2, 3, 4)
LEXICON_COUNT, LEXICON_SHARE = 2, 0.9
EPOCHS, BATCH, RATE, L2 = 6, 128, 0.2, 1e-5
UNKNOWN = "und"


class Words:
    """Words of some texts, and the features of the distinct ones."""

    def __init__(self, column: pa.Array):
        buf, offsets = common.text_buffer(column)
        self.n = len(column)
        points, at = textscan.code_points(buf) if len(buf) else (np.empty(0, np.uint32), np.empty(0, np.int64))
        letter = np.zeros(len(buf) + 1, np.int64)
        letter[at + 1] = textscan.char_classes()[points] == 1
        letters = np.cumsum(letter)
        self.has_letter = letters[offsets[1:]] > letters[offsets[:-1]]
        buf = textscan.LOWER[buf]
        start, end, self.owner = textscan.spans(buf, offsets, textscan.ALNUM)
        self.lettered = letters[end] > letters[start]
        sums = textscan.prefix_sums(buf)
        h = textscan.span_hash(sums, start, end)
        self.hash, first, self.inverse = np.unique(h, return_index=True, return_inverse=True)
        self.start, self.end, self.sums, self.buf = start[first], end[first], sums, buf

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(table rows of all distinct words one word after another, number of each)."""
        size = self.end - self.start
        rows, owner = [self.hash], [np.arange(len(size))]
        for kind, n in [*((1, n) for n in PREFIXES), *((2, n) for n in SUFFIXES)]:
            word = np.flatnonzero(size > n)
            a = self.start[word] if kind == 1 else self.end[word] - n
            rows.append(textscan.mix(textscan.span_hash(self.sums, a, a + n) + U64(kind)))
            owner.append(word)
        for n in GRAMS:
            count = np.maximum(size - n + 1, 0)
            a = common.ragged(self.start, count)
            rows.append(textscan.mix(textscan.span_hash(self.sums, a, a + n) + U64(3)))
            owner.append(np.repeat(np.arange(len(size)), count))
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        rows = (np.concatenate(rows) % U64(TABLE)).astype(np.int64)
        return rows[order], np.bincount(owner, minlength=len(size))


class Field:
    def __init__(self, labels: list[str], table: np.ndarray, lexicon: np.ndarray, lexicon_label: np.ndarray,
                 lexicon_weight: np.ndarray, first: np.ndarray, change: np.ndarray):
        self.labels, self.table, self.lexicon, self.lexicon_label = labels, table, lexicon, lexicon_label
        self.lexicon_weight, self.first, self.change = lexicon_weight, first, change

    def in_lexicon(self, h: np.ndarray) -> np.ndarray:
        """Label whose lexicon has the word, or -1."""
        if not len(self.lexicon):
            return np.full(len(h), -1)
        i = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        return np.where(self.lexicon[i] == h, self.lexicon_label[i], -1)

    def unary(self, rows: np.ndarray, count: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
        """Scores of the distinct words by label."""
        if not len(count):
            return np.zeros((0, len(self.labels)))
        out = np.add.reduceat(self.table[rows], np.cumsum(count) - count, axis=0)
        return out + np.where(lexicon[:, None] >= 0, self.lexicon_weight[lexicon], 0)

    def marginals(self, scores: np.ndarray, begin: np.ndarray, size: np.ndarray,
                  pairs: np.ndarray | None = None) -> np.ndarray:
        """Label distribution of every word of chains that follow one another. To ``pairs``, if
        given, the expected number of neighbours with each two labels is added."""
        out = np.empty_like(scores)
        emit = np.exp(np.clip(scores - scores.max(1, keepdims=True), -50, 0))
        change = np.exp(self.change)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if len(size) else []
        alpha = None
        for t, n in enumerate(active):
            at = begin[:n] + t
            alpha = np.exp(self.first) * emit[at] if t == 0 else (alpha[:n] @ change) * emit[at]
            alpha /= alpha.sum(1, keepdims=True)
            out[at] = alpha
        beta = np.ones((len(size), len(self.labels)))
        for t in range(len(active) - 2, -1, -1):
            n = active[t + 1]
            at = begin[:n] + t
            behind = beta[:n] * emit[at + 1]
            if pairs is not None:
                # alpha of this word, the transition, emission and beta of the next one, over their sum
                both = out[at][:, :, None] * change[None] * behind[:, None, :]
                pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
            b = behind @ change.T
            b /= b.sum(1, keepdims=True)
            beta[:n] = b
            p = out[at] * b
            out[at] = p / p.sum(1, keepdims=True)
        return out

    def label(self, column: pa.Array) -> tuple[Words, np.ndarray]:
        """Words and the label distribution of each."""
        words = Words(column)
        scores = self.unary(*words.features(), self.in_lexicon(words.hash))[words.inverse]
        size = textscan.counts_of(words.owner, words.n)
        full = size > 0
        return words, self.marginals(scores, (np.cumsum(size) - size)[full], size[full])


def train(segments: list[str], labels: list[str]) -> Field | None:
    """Fit on segments of words and their languages."""
    names = sorted(set(labels))
    if not names:
        return None
    k = len(names)
    gold = np.array([names.index(x) for x in labels])
    words = Words(pa.array(segments, pa.string()))
    word_label = gold[words.owner]
    # lexicons
    seen = np.stack([np.bincount(words.inverse[word_label == j], minlength=len(words.hash)) for j in range(k)], 1)
    best = seen.argmax(1)
    total = seen.sum(1)
    own = (seen.max(1) >= LEXICON_COUNT) & (seen.max(1) >= LEXICON_SHARE * total)
    field = Field(names, np.zeros((TABLE, k), np.float32), words.hash[own], best[own], np.zeros((k, k)),
                  np.zeros(k), np.zeros((k, k)))
    rows, count = words.features()
    begin = np.cumsum(count) - count
    lexicon = field.in_lexicon(words.hash)
    size = textscan.counts_of(words.owner, words.n)
    start = np.cumsum(size) - size
    rng = np.random.Generator(np.random.PCG64(5))
    g_table, g_lex = np.full((TABLE, k), 1e-6, np.float32), np.full((k, k), 1e-6)
    g_first, g_change = np.full(k, 1e-6), np.full((k, k), 1e-6)

    def step(value, grown, gradient):
        grown += gradient ** 2
        value -= RATE * gradient / np.sqrt(grown)

    usable = np.flatnonzero(size)
    for _ in range(EPOCHS):
        order = rng.permutation(usable)
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            # chains of two segments each (the last may stand alone)
            token = common.ragged(start[part], size[part])
            chain = np.concatenate([size[part][0::2], [0] * (len(part) % 2 == 0)]).astype(np.int64)[:(len(part) + 1) // 2]
            chain[:len(part) // 2] += size[part][1::2]
            at = np.cumsum(chain) - chain
            used, inv = np.unique(words.inverse[token], return_inverse=True)
            own_rows = rows[common.ragged(begin[used], count[used])]
            scores = field.unary(own_rows, count[used], lexicon[used])[inv]
            pairs = np.zeros((k, k))
            p = field.marginals(scores, at, chain, pairs)
            y = np.zeros_like(p)
            y[np.arange(len(token)), word_label[token]] = 1
            error = (p - y) / len(chain)
            # neighbours: expected pairs of labels against the true ones
            head = np.zeros(len(token), bool)
            head[at] = True
            second = np.flatnonzero(~head)
            np.add.at(pairs, (word_label[token[second - 1]], word_label[token[second]]), -1)
            d_change = pairs / len(chain)
            d_first = error[at].sum(0)
            by_word = np.stack([np.bincount(inv, error[:, j], len(used)) for j in range(k)], 1)
            d_lex = np.zeros((k, k))
            known = lexicon[used] >= 0
            np.add.at(d_lex, lexicon[used][known], by_word[known])
            row, where = np.unique(own_rows, return_inverse=True)
            spread = np.repeat(by_word, count[used], axis=0)
            d_table = np.stack([np.bincount(where, spread[:, j], len(row)) for j in range(k)], 1) + L2 * field.table[row]
            g_table[row] += d_table ** 2
            field.table[row] -= RATE * d_table / np.sqrt(g_table[row])
            step(field.lexicon_weight, g_lex, d_lex)
            step(field.first, g_first, d_first)
            step(field.change, g_change, d_change + 1e-3 * field.change)
    return field


def learnable(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    return docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Field | None:
    """Fit on a bounded sample of ``docs``; see ``SAMPLE``."""
    common.prepare(docs.sparkSession)
    key = F.xxhash64(F.col(id_col).cast("string"))
    part = F.pmod("_key", F.lit(PARTS))
    turns = Window.partitionBy("_lang").orderBy("_key")
    few = (learnable(docs, id_col, lang_col).select(key.alias("_key"), F.col(lang_col).cast("string").alias("_lang"))
           .distinct().withColumn("_place", F.row_number().over(Window.partitionBy("_lang", part).orderBy("_key")))
           .where(F.col("_place") <= 4 * SAMPLE // PARTS).select("_key", "_lang"))
    chosen = common.stored(
        few.withColumn("_turn", F.row_number().over(turns)).where(F.col("_turn") <= SAMPLE)
        .orderBy("_turn", "_key", "_lang").limit(SAMPLE).select("_key", "_lang"), "sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                buf, offsets = common.text_buffer(rows.column("_text"))
                start, end, owner = textscan.spans(textscan.LOWER[buf], offsets, textscan.ALNUM)
                size = textscan.counts_of(owner, rows.num_rows)
                begin = np.cumsum(size) - size
                out = []
                for i, k in enumerate(rows.column("_key").to_pylist()):
                    first = begin[i] + k % max(1, size[i] - SEGMENT + 1)
                    last = min(first + SEGMENT, begin[i] + size[i]) - 1
                    out.append(b" ".join(buf[a:b].tobytes() for a, b in zip(start[first:last + 1], end[first:last + 1])))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_lang"), pa.array(out, pa.binary()).cast(pa.string())], ["lang", "segment"])

    texts = learnable(docs, id_col, lang_col).select(
        key.alias("_key"), F.col(lang_col).cast("string").alias("_lang"), common.utf8_text(text_col).alias("_text"))
    rows = (texts.join(chosen, ["_key", "_lang"], "left_semi").select("_key", "_lang", "_text")
            .mapInArrow(cut, "lang string, segment string").where("segment != ''")
            .orderBy(F.xxhash64("segment"), "segment", "lang").limit(SAMPLE).collect())
    return train([r.segment for r in rows], [r.lang for r in rows])


#: Probability from which a word's language counts as known.
SURE = 0.5
RUNS = "runs array<struct<word:int,words:int,lang:string>>"
_RUN = pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))


def predict(docs: DataFrame, field: Field | None, text_col: str = "text", runs: bool = False,
            sure: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (the mean probability of that language), and if asked
    for, the runs of words with one likeliest language (first word, number of words, language), and
    sure: the share of the words with a letter of which some language has a probability of
    ``SURE`` or more, which one does not matter. ``text_col`` is passed on."""
    common.prepare(docs.sparkSession)
    common.require(docs, text_col)
    made = ["lang_pred", "score", *(["runs"] if runs else []), *(["sure"] if sure else [])]
    keep = [c for c in docs.columns if c not in made]
    names = field.labels if field else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, text_col):
                n = rows.num_rows
                lang, score, share, spans = [UNKNOWN] * n, np.zeros(n), np.zeros(n), [[] for _ in range(n)]
                if field:
                    words, p = field.label(rows.column(text_col))
                    own = words.owner[words.lettered]
                    sums = np.stack([np.bincount(own, p[words.lettered, j], n) for j in range(len(names))], 1)
                    lettered = np.maximum(np.bincount(own, minlength=n), 1)
                    score = np.minimum(sums.max(1) / lettered, 1.0)
                    share = np.bincount(own, p[words.lettered].max(1) >= SURE, n) / lettered
                    best = sums.argmax(1)
                    lang = [names[b] if ok else UNKNOWN for b, ok in zip(best, words.has_letter)]
                    if runs:
                        label = p.argmax(1)
                        change = np.concatenate([[True], (label[1:] != label[:-1]) | (words.owner[1:] != words.owner[:-1])])
                        at = np.flatnonzero(change[:len(label)])
                        size = np.diff(np.append(at, len(label)))
                        head = np.searchsorted(words.owner, np.arange(n))
                        for a, m in zip(at.tolist(), size.tolist()):
                            o = words.owner[a]
                            spans[o].append({"word": a - int(head[o]), "words": m, "lang": names[label[a]]})
                out = [pa.array(lang, pa.string()), pa.array(score)]
                if runs:
                    out.append(pa.array(spans, _RUN))
                if sure:
                    out.append(pa.array(share))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *out], [*keep, *made])

    typed = docs.withColumn(text_col, common.utf8_text(text_col)).select(*keep)
    return typed.mapInArrow(run, common.schema_of(
        typed, keep, "lang_pred string, score double" + (f", {RUNS}" if runs else "")
        + (", sure double" if sure else "")))


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text modulo 4 is 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, label all."""
    field = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), field).drop("text")
