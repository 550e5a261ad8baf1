"""Interpolated modified Kneser-Ney model of order 3 over words (operator 5).

Counted in Spark, kept as sorted hash arrays in the shared folder (``hashstore``), and
memory-mapped by the tasks that score texts, so neither the driver nor a task holds the model.

* Vocabulary: word hash -> number and count.
* Bigrams: mixed (context number, word number) -> count. Mixing is bijective, so bigrams never
  collide, and spreads the bigrams of one hot context over all shards.
* Trigrams: mixed (place of the context bigram, word number) -> count. The place and the number
  share 64 bits, so trigrams never collide either.
* Statistics are columns in the order of the words and of the bigrams (``Aligned``), found by the
  place of a key that is looked up anyway: of a bigram, its continuations (distinct tokens before
  it, its count where it begins a text) and the trigrams that it begins; of a word, the bigrams
  that it ends and, as a context of continuations, their kinds and total.

The trigram level discounts by D1, D2, D3+ from the counts of counts and interpolates with the
continuations of bigrams, discounted by their own counts of counts, these with the continuations of
words (number of distinct words before), and those with 1 / (V + 1) for V words and one unknown. An
unknown or unseen context has no weight of its own: the lower level alone counts. The first token
of a text has the begin alone before it and is scored by the bigrams.

Numbers of words take 32 bits of a bigram's key, and places of bigrams and numbers of words
together 64 bits of a trigram's; ``fit`` raises beyond that.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end; the first is read
after a begin that is not a token. Null text has the end alone. Repeated rows are learned and
scored each. Without training rows every probability is the uniform one. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common, files, hashstore, textscan

U64 = np.uint64
#: Hash of the end token (a word has it by chance only).
END = U64(0xE05E05E05E05E05E)
#: Numbers of words that are not in the vocabulary, of the begin, and of the first word.
UNKNOWN, BEGIN, FIRST = U64(0), U64(1), U64(2)
#: Keys of texts gathered in a task before they are counted: the more, the fewer are shuffled.
TEXT_KEYS = 2 * hashstore.FLUSH_KEYS
#: Bits of the kind of a statistic in its key.
KIND_BITS = 3


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every token, the end of each text included."""
    buf, offsets = common.text_buffer(column)
    buf = textscan.LOWER[buf]
    start, end, owner = textscan.spans(buf, offsets, textscan.NOT_SPACE)
    h = textscan.word_hash(buf, start, end)
    sizes = textscan.counts_of(owner, len(column)) + 1
    out = np.empty(int(sizes.sum()), U64)
    ends = np.cumsum(sizes) - 1
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end] = END
    out[~is_end] = h
    return out, np.repeat(np.arange(len(column)), sizes)


def _unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of ``textscan.mix``."""
    def unshift(y, s):
        out = y
        for _ in range(64 // s):
            out = y ^ (out >> U64(s))
        return out

    x = unshift(x, 31) * U64(pow(0x94D049BB133111EB, -1, 2**64))
    x = unshift(x, 27) * U64(pow(0xBF58476D1CE4E5B9, -1, 2**64))
    return unshift(x, 30)


def _pairs(number: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context number of every token, and the mixed key of the bigram."""
    before = np.empty(len(number), U64)
    before[1:] = number[:-1]
    before[np.concatenate([[True], owner[1:] != owner[:-1]])[:len(number)]] = BEGIN
    return before, textscan.mix(before << U64(32) | number)


def _firsts(owner: np.ndarray) -> np.ndarray:
    """Which tokens are the first of their text."""
    return np.concatenate([[True], owner[1:] != owner[:-1]])[:len(owner)]


def _kinds(counts: np.ndarray) -> np.ndarray:
    return np.minimum(counts, 3).astype(U64) - U64(1)


def _discounts(n: list[int]) -> np.ndarray:
    """D1, D2, D3+ from the numbers of types counted once to four times; plain 0.5, 1, 1.5 where
    too little data leaves them undefined."""
    n1, n2, n3, n4 = n
    d = [0.5, 1.0, 1.5]
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        d[0] = 1 - 2 * y * n2 / n1
        if n3:
            d[1] = 2 - 3 * y * n3 / n2
            if n4:
                d[2] = 3 - 4 * y * n4 / n3
    return np.array([0.0, *np.clip(d, 0.01, [0.99, 1.99, 2.99])])


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


class Aligned:
    """Columns in the order of a store's keys, without keys of their own: by shard, the tag of its
    files and the number of their entries. A missing shard has zeros."""

    def __init__(self, store: hashstore.Store, tags: dict[int, tuple[str, int]]):
        self.store, self.tags = store, tags
        self.maps: dict[tuple[int, str], np.ndarray] = {}

    def __reduce__(self):
        return Aligned, (self.store, self.tags)

    def column(self, shard: int, name: str) -> np.ndarray:
        if (shard, name) not in self.maps:
            tag, n = self.tags[shard]
            self.maps[shard, name] = files.mapped(f"{self.store.folder}/{tag}.{name}", n)
        return self.maps[shard, name]

    def get(self, keys: np.ndarray, place: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
        """Values at the places of ascending keys of the store (0 where missing)."""
        out = [np.zeros(len(keys), np.int64) for _ in names]
        edges = np.searchsorted(hashstore.shard_of(keys, self.store.bits), np.arange((1 << self.store.bits) + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            if s not in self.tags:
                continue
            at = edges[s] + np.flatnonzero(place[edges[s]:edges[s + 1]] >= 0)
            for to, name in zip(out, names):
                to[at] = self.column(s, name)[place[at]]
        return out


def _address(number: np.ndarray, base: np.ndarray, bits: int, kind: np.ndarray | int) -> np.ndarray:
    """Key of a statistic of the entry with this number: its shard, place and kind."""
    shard = np.searchsorted(base, number, side="right") - 1
    place = number - base[shard]
    return shard.astype(U64) << U64(64 - bits) | place << U64(KIND_BITS) | np.asarray(kind, U64)


def _aligned(rows: DataFrame, store: hashstore.Store, kinds: tuple[str, ...], extra: int, name: str, tell
             ) -> tuple[Aligned, DataFrame]:
    """Columns of a store from counted addresses. Shard 0 has ``extra`` entries more than keys.
    ``tell`` gives figures of a shard from its columns, as the columns f0.. f3."""
    bits = store.bits

    def save(shard, keys, counts):
        n = store.names.get(shard, ("", 0))[1] + (extra if shard == 0 else 0)
        at = keys & U64((1 << (64 - bits)) - 1)
        place, kind = (at >> U64(KIND_BITS)).astype(np.int64), at & U64((1 << KIND_BITS) - 1)
        tag = files.attempt_name(f"{shard:06d}-{name}")
        columns = []
        for k, column in enumerate(kinds):
            values = np.zeros(n, np.int64)
            mine = kind == k
            values[place[mine]] = counts[mine]
            files.write(f"{store.folder}/{tag}.{column}", hashstore._small(values)[1:])
            columns.append(values)
        row = [pa.array([shard], pa.int32()), pa.array([tag]), pa.array([n], pa.int64())]
        yield pa.RecordBatch.from_arrays([*row, *(pa.array([int(x)], pa.int64()) for x in tell(columns))],
                                         ["shard", "tag", "n", "f0", "f1", "f2", "f3"])

    listed = common.stored(hashstore.shards(
        rows, save, "shard int, tag string, n long, f0 long, f1 long, f2 long, f3 long"), name)
    return Aligned(store, {r.shard: (r.tag, r.n) for r in listed.select("shard", "tag", "n").collect()}), listed


def _places(keys: np.ndarray, place: np.ndarray, base: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of bigrams by their places in their shards (any number where missing)."""
    return base[hashstore.shard_of(keys, bits)] + np.maximum(place, 0).astype(U64)


class Model:
    """The stores of a fitted model and its totals."""

    def __init__(self, words: hashstore.Store, base: np.ndarray, of_words: Aligned, pairs: hashstore.Store,
                 pair_base: np.ndarray, of_pairs: Aligned, continued: Aligned, triples: hashstore.Store,
                 word_bits: int, tokens: int, d3: np.ndarray, d2: np.ndarray, d1: np.ndarray, of_counts: list[int]):
        self.words, self.base, self.of_words, self.pairs, self.pair_base = words, base, of_words, pairs, pair_base
        self.of_pairs, self.continued, self.triples, self.word_bits = of_pairs, continued, triples, word_bits
        self.tokens, self.d3, self.d2, self.d1 = tokens, d3, d2, d1
        self.types = len(pairs)
        n1, n2 = of_counts[:2]
        n3 = len(words) - n1 - n2
        self.rest = (d1[1] * n1 + d1[2] * n2 + d1[3] * n3) / self.types if self.types else 1.0

    def begin(self) -> list[int]:
        """Statistics of the begin as a context; they follow the words of the first shard."""
        if 0 not in self.of_words.tags:
            return [0, 0, 0, 0]
        return [int(self.of_words.column(0, k)[-1]) for k in ("once", "twice", "often", "total")]

    def score(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """Numbers of tokens and of known ones, log10 of the base and of the model's probability
        of each text."""
        h, owner = _tokens(column)
        n, uniform = len(column), 1.0 / (len(self.words) + 1)
        distinct, inverse = np.unique(h, return_inverse=True)
        place, (count,) = self.words.get(distinct)
        number = _numbers(self.words, self.base, distinct, place)
        base = np.log10((count + 1) / (self.tokens + len(self.words) + 1))[inverse]
        continued, *stats = self.of_words.get(distinct, place, ("continued", "once", "twice", "often", "total"))
        low = (np.maximum(continued - self.d1[np.minimum(continued, 3)], 0) / max(self.types, 1)
               + self.rest * uniform)[inverse]

        # one word before: the distinct words and the begin are the contexts
        ones, twos, more, total = (np.append(a, b) for a, b in zip(stats, self.begin()))
        back = (self.d2[1] * ones + self.d2[2] * twos + self.d2[3] * more) / np.maximum(total, 1)
        number = number[inverse]
        before, key = _pairs(number, owner)
        first = _firsts(owner)
        context = np.empty(len(h), np.int64)
        context[1:] = inverse[:-1]
        context[first] = len(distinct)
        pairs, pair_of = np.unique(key, return_inverse=True)
        place, (pair_count,) = self.pairs.get(pairs)
        a = self.continued.get(pairs, place, ("continued",))[0][pair_of]
        of = total[context]
        p = np.where((before > 0) & (of > 0),
                     np.maximum(a - self.d2[np.minimum(a, 3)], 0) / np.maximum(of, 1) + back[context] * low, low)

        # two words before: the distinct bigrams are the contexts
        ones, twos, more = self.of_pairs.get(pairs, place, ("once", "twice", "often"))
        back = (self.d3[1] * ones + self.d3[2] * twos + self.d3[3] * more) / np.maximum(pair_count, 1)
        at = np.flatnonzero(~first)
        of = pair_of[at - 1]
        at, of = at[place[of] >= 0], of[place[of] >= 0]
        numbers = _places(pairs, place, self.pair_base, self.pairs.bits)
        seen = self.triples.look_up(textscan.mix(numbers[of] << U64(self.word_bits) | number[at]))[0]
        p[at] = np.maximum(seen - self.d3[np.minimum(seen, 3)], 0) / pair_count[of] + back[of] * p[at]
        return (np.bincount(owner, minlength=n), np.bincount(owner, (count > 0)[inverse], n).astype(np.int64),
                np.bincount(owner, base, n), np.bincount(owner, np.log10(p), n))


def _numbers(words: hashstore.Store, base: np.ndarray, distinct: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers (UNKNOWN where missing) of ascending distinct word hashes."""
    return np.where(place >= 0, base[hashstore.shard_of(distinct, words.bits)] + place.astype(U64), UNKNOWN)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the model on all rows of ``docs``."""
    spark = common.prepare(docs.sparkSession)
    bits = hashstore.shard_bits(spark)
    texts = docs.select(common.utf8_text(text_col).alias("_text"))

    def keys(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counter = hashstore.Counter(bits, TEXT_KEYS)
            for batch in batches:
                for rows in common.slices(batch, "_text"):
                    yield from counter.add(make(*_tokens(rows.column("_text"))))
            yield from counter.flush()
        return texts.mapInArrow(run, hashstore.PACKED)

    def store(packed_rows: DataFrame, name: str, tell) -> tuple[hashstore.Store, DataFrame]:
        """Store with counts; ``tell`` gives further figures of a shard, as the columns f0.. f3."""
        folder = common.shared_folder(spark, name)

        def save(shard, k, counts):
            row = hashstore.save(folder, shard, k, counts=counts)
            for i, f in enumerate(tell(counts)):
                row = row.append_column(f"f{i}", pa.array([int(f)], pa.int64()))
            yield row

        listed = common.stored(hashstore.shards(
            packed_rows, save, hashstore.LISTED + "".join(f", f{i} long" for i in range(4))), name)
        return hashstore.opened(spark, folder, listed, ("counts",)), listed

    def figures(listed: DataFrame) -> list[int]:
        return [x or 0 for x in listed.agg(*(F.sum(f"f{i}") for i in range(4))).head()]

    def starts(of: hashstore.Store) -> np.ndarray:
        sizes = np.array([of.names.get(s, ("", 0))[1] for s in range(1 << bits)], U64)
        return np.cumsum(sizes) - sizes

    def blocks(batches: Iterator[pa.RecordBatch], of: hashstore.Store):
        """Shards of a store in parts that a task reads at once."""
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                for i in range(0, of.names.get(shard, ("", 0))[1], hashstore.FLUSH_KEYS):
                    yield shard, slice(i, i + hashstore.FLUSH_KEYS)

    words, listed = store(keys(lambda h, _: h), "words", lambda counts: [counts.sum(), 0, 0, 0])
    tokens = figures(listed)[0]
    base = FIRST + starts(words)
    word_bits = (len(words) + int(FIRST)).bit_length()
    if word_bits > 32:
        raise ValueError(f"numbers of {len(words)} words do not fit in the 32 bits of a bigram key")

    def word_numbers(h):
        distinct, inverse = np.unique(h, return_inverse=True)
        return _numbers(words, base, distinct, words.get(distinct)[0])[inverse]

    pairs, listed = store(keys(lambda h, owner: _pairs(word_numbers(h), owner)[1]), "pairs", lambda counts: [0] * 4)
    pair_shards = listed.select("shard").repartitionById(1 << bits, "shard")
    pair_base = starts(pairs)
    if len(pairs).bit_length() + word_bits > 64:
        raise ValueError(f"{len(pairs)} bigrams of {len(words)} words do not fit in 64-bit trigram keys")

    def triple_keys(h, owner):
        number = word_numbers(h)
        key, pair_of = np.unique(_pairs(number, owner)[1], return_inverse=True)
        numbers = _places(key, pairs.get(key)[0], pair_base, bits)[pair_of]
        at = np.flatnonzero(~_firsts(owner))
        return textscan.mix(numbers[at - 1] << U64(word_bits) | number[at])

    triples, listed = store(keys(triple_keys), "triples", _of_counts)
    d3 = _discounts(figures(listed))
    triple_shards = listed.select("shard").repartitionById(1 << bits, "shard")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kinds of the trigrams that each bigram begins."""
        counter = hashstore.Counter(bits)
        for shard, part in blocks(batches, triples):
            triple = _unmix(np.array(triples.column(shard, "keys")[part]))
            yield from counter.add(_address(triple >> U64(word_bits), pair_base, bits,
                                            _kinds(triples.column(shard, "counts")[part])))
        yield from counter.flush()

    of_pairs, _ = _aligned(triple_shards.mapInArrow(contexts, hashstore.PACKED), pairs,
                           ("once", "twice", "often"), 0, "contexts", lambda _: [0] * 4)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last two words of every distinct trigram, as a bigram."""
        counter = hashstore.Counter(bits)
        for shard, part in blocks(batches, triples):
            triple = _unmix(np.array(triples.column(shard, "keys")[part]))
            triple.sort()                                  # by place: bigrams are read in order
            number = triple >> U64(word_bits)
            owner = np.searchsorted(pair_base, number, side="right") - 1
            middle = np.empty(len(triple), U64)
            for s in np.unique(owner).tolist():
                mine = slice(*np.searchsorted(owner, [s, s + 1]))
                middle[mine] = pairs.column(s, "keys")[(number[mine] - pair_base[s]).astype(np.int64)]
            middle = _unmix(middle) & U64(0xFFFFFFFF)
            yield from counter.add(textscan.mix(middle << U64(32) | triple & U64((1 << word_bits) - 1)))
        yield from counter.flush()

    def begins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bigrams that begin texts, with their counts."""
        for shard, part in blocks(batches, pairs):
            key = np.array(pairs.column(shard, "keys")[part])
            mine = (_unmix(key) >> U64(32)) == BEGIN
            yield from hashstore.packed(key[mine], pairs.column(shard, "counts")[part][mine].astype(np.int64), bits)

    def save(shard, k, counts):
        if not np.array_equal(k, pairs.column(shard, "keys")):
            raise ValueError("continuations of other bigrams than were counted")
        tag = files.attempt_name(f"{shard:06d}-continued")
        files.write(f"{pairs.folder}/{tag}.continued", hashstore._small(counts)[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([tag]), pa.array([len(k)], pa.int64()),
             *(pa.array([x], pa.int64()) for x in _of_counts(counts))],
            ["shard", "tag", "n", *(f"f{i}" for i in range(4))])

    both = pair_shards.mapInArrow(begins, hashstore.PACKED).unionByName(
        triple_shards.mapInArrow(ends, hashstore.PACKED))
    listed = common.stored(hashstore.shards(both, save, "shard int, tag string, n long" + "".join(
        f", f{i} long" for i in range(4))), "continued")
    continued = Aligned(pairs, {r.shard: (r.tag, r.n) for r in listed.select("shard", "tag", "n").collect()})
    d2 = _discounts(figures(listed))

    def of_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Statistics of the two words of every distinct bigram."""
        # the begin follows the words of the first shard
        begin = U64(words.names.get(0, ("", 0))[1]) << U64(KIND_BITS)
        for shard, part in blocks(batches, pairs):
            pair = _unmix(np.array(pairs.column(shard, "keys")[part]))
            n = continued.column(shard, "continued")[part].astype(np.int64)
            word, one = pair >> U64(32), np.ones(len(pair), np.int64)
            kinds = _kinds(n) + U64(1)
            started = word == BEGIN
            at = _address(np.where(started, base[0], word), base, bits, 0)
            at[started] = begin
            key = np.concatenate([_address(pair & U64(0xFFFFFFFF), base, bits, 0), at | kinds, at | U64(4)])
            yield from hashstore.packed(*hashstore.counted(key, np.concatenate([one, one, n])), bits)

    of_words, listed = _aligned(pair_shards.mapInArrow(of_word, hashstore.PACKED), words,
                                ("continued", "once", "twice", "often", "total"), 1, "of-words",
                                lambda columns: _of_counts(columns[0]))
    of_counts = figures(listed)
    return Model(words, base, of_words, pairs, pair_base, of_pairs, continued, triples, word_bits, tokens, d3, d2,
                 _discounts(of_counts), of_counts)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with n_tokens, n_known, base_score, score (log10 of the
    probabilities under add-one unigrams and under the model)."""
    common.require(docs, text_col)
    made = ["n_tokens", "n_known", "base_score", "score"]
    keep = [c for c in docs.columns if c != text_col and c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), *map(pa.array, model.score(rows.column("_text")))],
                    [*keep, *made])

    source = docs.select(*keep, common.utf8_text(text_col).alias("_text"))
    return source.mapInArrow(run, common.schema_of(
        source, keep, "n_tokens long, n_known long, base_score double, score double"))


def held_out(id_col: str, mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == remainder, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, score all: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score, perplexity."""
    out = held_out("doc_id", 7, 2)
    model = fit(docs.where(~out))
    scored = score(docs.select("doc_id", out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                         "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
