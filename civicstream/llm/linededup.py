"""Deletion of repeated line runs (operator 9); DataFrame operations only.

The lines of a document that hold a word are its sequence of line ids (128-bit hashes). A suffix
is named by its first 1, 2, 4, ... lines: prefix doubling joins the name of a position with the
name of the position that far on. Positions whose name occurs once can have no longer repeat and
leave at once, so each round works on the repeated part only. At the depth of ``min_lines`` lines
(the last two names may overlap), suffixes of one name are neighbours in the suffix order with a
common prefix of at least ``min_lines``; together the overlapping ones are the maximal repeated
runs. Of each name the first position stays, and the lines of all later ones are deleted: the
first by document id, then by a hash of the text.

So a line goes if it lies in a run of ``min_lines`` lines that also begins at an earlier place, in
the same document or another. A run of one or two lines (below ``min_lines``) is enough when it
holds ``long_words`` words: levels 1 and 2 carry the number of words, and the later copies of their
long names go too. With ``long_words=None`` such a passage stays however long it is.

Lines without a word are no part of runs and stay. Null text stays null; texts without a run
stay as they are. Null document ids come first. Repeated rows are copies of each other: all but
one lose their runs (which one, is not to be told apart). Empty tables give no rows. All columns
of the input are kept, with ``text_col`` replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstream.llm import common

MIN_LINES = 3
#: Words that make a repeated run of one or two lines long enough to be deleted.
LONG_WORDS = 50

_WHITE = "concat(' ', char(9), char(10), char(11), char(12), char(13))"


def _repeated(positions: DataFrame, name: str) -> DataFrame:
    """The positions whose name (a, b) occurs twice or more."""
    names = positions.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("a", "b")
    return common.stored(positions.join(names, ["a", "b"]), name)


def later_runs(texts: DataFrame, min_lines: int, long_words: int | None) -> DataFrame:
    """rid, lines: the line numbers (from 0) that each text (rid, doc, text) loses, if any."""
    lines = "split(text, '\\\\n', -1)"
    words = f"size(split(btrim(l, {_WHITE}), '[ \\\\x09-\\\\x0D]+', -1))" if long_words else "0"
    spread = texts.select("rid", "doc", F.xxhash64("text").alias("hash"), F.posexplode(F.expr(
        f"filter(transform({lines}, (l, i) -> if(btrim(l, {_WHITE}) = '', null,"
        " struct(array(i) as at, xxhash64(l) as a, xxhash64(l, 1) as b,"
        f" {words} as words))), x -> x is not null)")).alias("j", "x"))
    level = _repeated(spread.select("rid", "doc", "hash", "j", "x.*"), "lines")
    size = 1
    runs = []
    while size < min_lines:
        if long_words and size <= 2:
            runs.append(level.where(F.col("words") >= long_words))
        step = min(size, min_lines - size)
        x, y = level.alias("x"), level.alias("y")
        joined = x.join(y, (F.col("x.rid") == F.col("y.rid")) & (F.col("x.j") + step == F.col("y.j")))
        level = _repeated(joined.select(
            "x.rid", "x.doc", "x.hash", "x.j", F.array_union("x.at", "y.at").alias("at"),
            (F.col("x.words") + F.col("y.words")).alias("words"),    # read at levels 1 and 2 only
            F.xxhash64("x.a", "y.a").alias("a"), F.xxhash64("x.b", "y.b", F.lit(2)).alias("b")), "runs")
        size += step
    for shorter in runs:
        level = level.unionByName(shorter)
    place = F.struct("doc", "hash", "rid", "j")
    first = level.groupBy("a", "b").agg(F.min(place).alias("first"))
    later = level.join(first, ["a", "b"]).where(
        (F.col("rid") != F.col("first.rid")) | (F.col("j") != F.col("first.j")))
    return (later.select("rid", F.explode("at").alias("line")).groupBy("rid")
            .agg(F.collect_set("line").alias("lines")))


def remove_repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id",
                         text_col: str = "text", long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with the later copies of line runs deleted from ``text_col``, and with n_lines
    (lines with a word) before, n_removed, and emptied (no line with a word is left of some)."""
    common.prepare(docs.sparkSession)
    common.require(docs, id_col, text_col)
    numbered = common.stored(docs.select(F.struct(*docs.columns).alias("row")).withColumn(
        "rid", F.monotonically_increasing_id()), "documents")
    text = F.col(f"row.{text_col}").cast("string")
    gone = later_runs(numbered.select("rid", F.col(f"row.{id_col}").alias("doc"), text.alias("text")), min_lines,
                      long_words)
    n_lines = F.expr(f"size(filter(split(text, '\\\\n', -1), l -> btrim(l, {_WHITE}) != ''))")
    rest = F.expr("element_at(transform(array(split(text, '\\\\n', -1)), s -> array_join(transform(array_except("
                  "sequence(0, size(s) - 1), lines), i -> s[i]), '\\n')), 1)")
    # an array_except that leaves nothing gives the empty text
    made = numbered.join(gone, "rid", "left").withColumn("text", text).select(
        "row", F.when(F.col("lines").isNull(), F.col("text")).otherwise(rest).alias("left"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"))
    kept = [F.col(f"row.{c}").alias(c) if c != text_col else F.col("left").alias(text_col)
            for c in docs.columns if c not in ("n_lines", "n_removed", "emptied")]
    return made.select(*kept, "n_lines", "n_removed",
                       ((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))).alias("emptied"))


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeated_runs(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", (~F.col("emptied")).alias("kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
