"""The pipeline against the brute-force versions of its stages, one after another."""

import hashlib

import corpus_pipeline
import numpy as np
import tiktoken
import public_tokenizers
from pyspark.sql import functions as F

from civicstream.llm import bpe, common, langid
from tests.llm import edge_cases
from tests.llm.test_decontam import brute as contaminated, ITEMS, items_for
from tests.llm.test_linededup import WORD, lost_lines
from tests.llm.test_setsketch import shingles

FOLDER = "/root/testdata/sf0.001"


def without_runs(docs):
    docs, out = sorted(docs), []
    for (d, t), gone in zip(docs, lost_lines(docs)):
        lines = t.split("\n")
        if not gone or len(gone) < sum(bool(WORD.search(x)) for x in lines):
            out.append((d, "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return out


def one_of_each(docs):
    sets = [shingles(t, 5) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)), key=lambda x: docs[x][0])
                    root[b] = a
    return [x for i, x in enumerate(docs) if find(i) == i]


def test_stages_equal_brute_force(spark):
    common.prepare(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    field = langid.fit(docs.where(~langid.held_out()))
    known = [(r.doc_id, r.text) for r in langid.predict(docs, field, sure=True).collect()
             if r.lang_pred != "und" and r.sure >= corpus_pipeline.LEAST_SURE]
    assert len(known) > 190
    left = one_of_each(without_runs(known))
    items = [(r.item_id, r.text, None) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(left, items) if r[5]}
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks=bpe.load_ranks(corpus_pipeline.RANKS).ranks)
    expected = sorted((d, reference.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest())
                      for d, t in left if d not in bad)
    got = sorted((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.decoded_sha256)
                 for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == expected and 0 < len(got) < len(known)


def test_edge_cases_through_every_stage(spark, tmp_dir):
    data = edge_cases.rows()
    spark.createDataFrame(items_for(data), ITEMS).write.parquet(f"{tmp_dir}/benchmark.parquet")
    for rows in (data, []):
        docs = edge_cases.table(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, tmp_dir)
            if name != "encoding":
                assert out.columns == docs.columns
                docs = common.stored(out, name)
        assert (out.count() > 0) == bool(rows)
    near = corpus_pipeline.near_dedup(spark, edge_cases.table(spark, data), tmp_dir).collect()
    # of the copies of one text (repeated rows, other cases, null ids) one row stays
    assert sum((r.text or "").lower() == data[5][1].lower() for r in near) == 1
    assert sum(not (r.text or "").strip() for r in near) == sum(not (r[1] or "").strip() for r in data)


def test_switching_and_unlabelled_texts_stay(spark):
    languages = {"aa": ["kono", "mitu", "sola", "reka"], "bb": ["grusst", "werdf", "holzt", "blickt"],
                 "cc": ["oeuil", "vieux", "beaux", "lieux"], "dd": ["ything", "wherely", "oughty", "thatly"]}
    rows = [(i * 4 + j, " ".join(w[(i + k) % 4] for k in range(20)), lang)
            for i in range(40) for j, (lang, w) in enumerate(languages.items())]
    mixed = " ".join(w for i in range(4) for words in languages.values() for w in [words[i]] * 3)
    rows += [(1000, mixed, None), (1001, "1 2 3", None), (1002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows} - {1001, 1002}
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, bare, "").collect()} == kept


def test_clashing_columns_come_back_unchanged(spark, tmp_dir):
    data = edge_cases.rows()
    spark.createDataFrame(items_for(data), ITEMS).write.parquet(f"{tmp_dir}/benchmark.parquet")
    extra = ["score", "lang_pred", "sure", "runs", "n_lines", "n_removed", "emptied", "_k", "_k0", "row", "root", "_in0"]
    docs = edge_cases.table(spark, data)
    for c in extra:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, tmp_dir), name)
        left = docs.select(*extra).distinct().collect()
        assert [tuple(r) for r in left] == [tuple(f"own {c}" for c in extra)]
