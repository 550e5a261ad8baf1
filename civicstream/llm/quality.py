"""Quality rules with adaptive thresholds (operator 2); DataFrame expressions only.

Signals of a document are counted within its row. Documents that pass the base rule feed
quantile sketches per language and source: histograms with buckets of a relative width of 1/64,
so sketches of parts merge by adding counts, in any order, to the same result. A document is kept
when each of its signals lies within q10 - REACH * (q50 - q10) and q90 + REACH * (q90 - q50) of
its language and source: the tails of the group set the fences, each side its own. A tail shorter
than the signal's few units of ``SIGNALS`` counts as that long, which matters where nine tenths of
a group are alike (``floor_decides`` counts such groups). Where more than a tenth of a group has
a habit, the fence follows it.

Null text has no words, and fails the base rule, as does every text below 20 words. Null
languages and sources are groups of their own. Repeated rows count each. Empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicstream.llm import common

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Words of a repeated window.
WINDOW = 8
#: Base rule: fewest words, and most percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Lengths of a tail (from the median to its decile) that a document may lie beyond the decile.
REACH = 3
#: Signals (all in thousandths but the word length, in hundredths of a character) and the least
#: lengths of their tails.
SIGNALS = {"symbols_pm": 5, "dup_lines_pm": 30, "repeats_pm": 20, "word_length": 10}
#: Buckets of a sketch from one power of two to the next, as a power of two.
BITS = 6

_WHITE = "concat(' ', char(9), char(10), char(11), char(12), char(13))"


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _repeat_words(words: str) -> str:
    """SQL: how many of these words lie in windows that occur twice or more."""
    marked = ("filter(s, (e, i) -> coalesce(get(s, i - 1).h = e.h, false) or coalesce(get(s, i + 1).h = e.h, false))")
    places = f"sort_array(transform({marked}, e -> e.i))"
    steps = f"transform(p, (x, k) -> cast(least({WINDOW}, coalesce(get(p, k + 1) - x, {WINDOW})) as bigint))"
    total = f"aggregate({steps}, 0L, (a, v) -> a + v)"
    sort = "sort_array(transform(h, (x, i) -> struct(x as h, i as i)))"
    counted = f"if(size(array_distinct(h)) = size(h), 0L, {_let('s', sort, _let('p', places, total))})"
    hashes = f"transform(sequence(1, size({words}) - {WINDOW - 1}), i -> xxhash64(slice({words}, i, {WINDOW})))"
    return f"if(size({words}) < {WINDOW}, 0L, {_let('h', hashes, counted)})"


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines (lines with a word)."""
    common.require(docs, text_col)
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    keep = [c for c in docs.columns if c != text_col and c not in made]
    text = f"coalesce(cast(`{text_col}` as string), '')"
    bare = "j"
    for c in SYMBOLS:
        bare = f"replace({bare}, '{c}', '')"
    words = f"if(t = '', cast(array() as array<string>), split(t, '[ \\\\x09-\\\\x0D]+', -1))"
    lines = f"filter(split(t, '\\\\n', -1), l -> btrim(l, {_WHITE}) != '')"
    from_words = (f"struct(cast(size(w) as bigint) as n_words, {_let('j', 'array_join(w, %s)' % repr(''), f'struct(cast(char_length(j) as bigint) as word_chars, cast(char_length(j) - char_length({bare}) as bigint) as n_symbols)')} as c, "
                  f"{_repeat_words('w')} as n_repeat_words)")
    from_lines = ("struct(cast(size(l) as bigint) as n_lines, "
                  "cast(size(l) - size(array_distinct(l)) as bigint) as n_dup_lines)")
    by_words = _let("t", f"btrim({text}, {_WHITE})", _let("w", words, from_words))
    by_lines = _let("t", text, _let("l", lines, from_lines))
    return (docs.select(*keep, F.expr(by_words).alias("_w"), F.expr(by_lines).alias("_l"))
            .select(*keep, "_w.n_words", "_w.c.word_chars", "_w.c.n_symbols", "_l.n_dup_lines",
                    "_w.n_repeat_words", "_l.n_lines"))


BASE_FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"

_SIGNAL_SQL = {
    "symbols_pm": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines_pm": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats_pm": "1000 * n_repeat_words div greatest(n_words, 1)",
    "word_length": "100 * word_chars div greatest(n_words, 1)",
}


def sketch(signals: DataFrame, groups: list[str]) -> DataFrame:
    """Histogram sketch of the documents that pass the base rule: ``groups``, signal, bucket,
    n. Sketches of parts are merged by ``merge``."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), F.expr(sql).alias("value"))
                               for s, sql in _SIGNAL_SQL.items()))).alias("x")
    shift = f"greatest(0, length(bin(value)) - {BITS + 1})"
    return (signals.where(f"not ({BASE_FAILED})").select(*groups, each).select(*groups, "x.signal", "x.value")
            .select(*groups, "signal", F.expr(f"{shift} * {1 << BITS} + shiftright(value, {shift})").alias("bucket"))
            .groupBy(*groups, "signal", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merge(*sketches: DataFrame) -> DataFrame:
    first = sketches[0]
    for s in sketches[1:]:
        first = first.unionByName(s)
    return first.groupBy(*[c for c in first.columns if c != "n"]).agg(F.sum("n").alias("n"))


def deciles(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """``groups``, signal, q10, q50, q90. A quantile is the lower end of its bucket."""
    up = Window.partitionBy(*groups, "signal").orderBy("bucket")
    every = Window.partitionBy(*groups, "signal")
    # bucket = shift * 64 + m with 64 <= m < 128 where shift > 0, and the value itself below 128
    shift = f"greatest(0, bucket div {1 << BITS} - 1)"
    ranked = (sketched.withColumn("low", F.expr(f"shiftleft(bucket - {1 << BITS} * ({shift}), cast({shift} as int))"))
              .withColumn("upto", F.sum("n").over(up)).withColumn("total", F.sum("n").over(every)))
    return ranked.groupBy(*groups, "signal").agg(*(
        F.min(F.expr(f"case when 10 * upto >= {d} * total then low end")).alias(f"q{d}0") for d in (1, 5, 9)))


def thresholds(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group: the fences <signal>_lo and <signal>_hi."""
    fences = []
    for s, least in SIGNALS.items():
        below, above = (F.greatest(tail, F.lit(least)) * REACH
                        for tail in (F.col("q50") - F.col("q10"), F.col("q90") - F.col("q50")))
        mine = F.col("signal") == s
        fences += [F.max(F.when(mine, F.col("q10") - below)).alias(f"{s}_lo"),
                   F.max(F.when(mine, F.col("q90") + above)).alias(f"{s}_hi")]
    return deciles(sketched, groups).groupBy(*groups).agg(*fences)


def floor_decides(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """Per signal: n_groups, in how many of them the least length of the tail sets the upper fence
    (n_floor), and in how many of these the tail is empty (n_constant)."""
    least = F.create_map(*(F.lit(x) for pair in SIGNALS.items() for x in pair))[F.col("signal")]
    tail = F.col("q90") - F.col("q50")
    return deciles(sketched, groups).groupBy("signal").agg(
        F.count(F.lit(1)).alias("n_groups"), F.count_if(tail < least).alias("n_floor"),
        F.count_if(tail == 0).alias("n_constant"))


def verdicts(docs: DataFrame, id_cols: list[str], text_col: str = "text",
             groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``id_cols``, the counts, base_failed, kept of every document."""
    common.prepare(docs.sparkSession)
    common.require(docs, *id_cols, text_col, *groups)
    named = [f"_g{i}" for i in range(len(groups))]
    ids = [f"_id{i}" for i in range(len(id_cols))]
    source = docs.select(*(F.col(c).alias(i) for c, i in zip(id_cols, ids)),
                         *(F.col(c).alias(g) for c, g in zip(groups, named)), F.col(text_col).alias("_text"))
    counted = common.stored(metrics(source, "_text"), "signals")
    fences = thresholds(sketch(counted, named), named)
    d, f = counted.alias("d"), fences.alias("f")
    same = F.lit(True)
    for g in named:
        same = same & F.col(f"d.{g}").eqNullSafe(F.col(f"f.{g}"))
    inside = " and ".join(f"({sql}) between {s}_lo and {s}_hi" for s, sql in _SIGNAL_SQL.items())
    failed = F.expr(BASE_FAILED)
    return (d.join(f, same, "left").select(
        *(F.col(i).alias(c) for i, c in zip(ids, id_cols)), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.coalesce(F.expr(inside), F.lit(True))).alias("kept")))


def digest(docs: DataFrame) -> DataFrame:
    return verdicts(docs, ["doc_id"])
