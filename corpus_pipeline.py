"""Training-text pipeline: language, repeated lines, near-duplicates, benchmark passages, ids.

Every stage takes (spark, docs, sf_dir) and returns a table that is written before the next one
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstream.llm import bpe, common, decontam, langid, linededup, setsketch

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Least share of a document's words whose language is known, whichever languages they are.
LEAST_SURE = 0.2


def _apart(docs: DataFrame, stage: Callable[[DataFrame, str, str], DataFrame]) -> DataFrame:
    """``stage`` on ``docs`` under column names that no operator makes, given those of doc_id and
    text; the columns of ``docs`` come back under their own names."""
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    out = stage(docs.toDF(*names.values()), names["doc_id"], names["text"])
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in no known language, go; a text that switches
    between languages stays. Without any labelled document all that have a letter stay."""
    field = langid.fit(docs.where(~langid.held_out()))
    if field is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return _apart(docs, lambda d, key, text: langid.predict(d, field, text, sure=True).where(
        (F.col("lang_pred") != langid.UNKNOWN) & (F.col("sure") >= LEAST_SURE)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are deleted; a document that consisted of them goes."""
    out = _apart(docs, lambda d, key, text: linededup.remove_repeated_runs(d, id_col=key, text_col=text)
                 .where("not emptied"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, 0.8)."""
    return _apart(docs, lambda d, key, text: setsketch.deduplicated(d, key, text, size=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apart(docs, lambda d, key, text: decontam.clean(d, items.withColumnRenamed("text", text), key, text))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text (little-endian unsigned 32-bit), and a digest of what they decode to."""
    common.prepare(spark)
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS)
    return bpe.decode(ids, RANKS).select(
        "doc_id", "lang", "source", bpe.n_ids(F.col("ids")).alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("encoding", encoding)]

#: The stages are tested against brute force; SQL cannot express the first and the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    common.prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
