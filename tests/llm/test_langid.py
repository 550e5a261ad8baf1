"""Operator 7: forward-backward against all label paths, held-out accuracy, edge cases."""

import itertools

import numpy as np
import pytest

from civicstream.llm import langid, queries
from tests.llm import edge_cases


def test_marginals_equal_the_sum_over_all_paths():
    rng = np.random.Generator(np.random.PCG64(1))
    k, sizes = 3, np.array([4, 1, 6, 2])
    field = langid.Field(list("abc"), None, np.empty(0), None, None, rng.normal(size=k), rng.normal(size=(k, k)))
    scores = rng.normal(size=(sizes.sum(), k))
    begin = np.cumsum(sizes) - sizes
    got = field.marginals(scores, begin, sizes)
    for b, n in zip(begin, sizes):
        expected = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=int(n)):
            s = field.first[path[0]] + sum(scores[b + t, y] for t, y in enumerate(path))
            s += sum(field.change[x, y] for x, y in zip(path, path[1:]))
            for t, y in enumerate(path):
                expected[t, y] += np.exp(s)
        assert got[b:b + n] == pytest.approx(expected / expected.sum(1, keepdims=True))


def _log_sum(change, first, scores, begin, sizes):
    total = 0.0
    for b, n in zip(begin, sizes):
        paths = [first[p[0]] + sum(scores[b + t, y] for t, y in enumerate(p)) + sum(change[x, y] for x, y in zip(p, p[1:]))
                 for p in itertools.product(range(len(first)), repeat=int(n))]
        total += np.logaddexp.reduce(paths)
    return total


def test_pairs_of_labels_equal_the_gradient_by_transitions():
    rng = np.random.Generator(np.random.PCG64(2))
    for _ in range(20):
        k, sizes = 3, np.array([4, 1, 5])
        first, change, scores = rng.normal(size=k), rng.normal(size=(k, k)) * 2, rng.normal(size=(sizes.sum(), k)) * 3
        begin = np.cumsum(sizes) - sizes
        pairs = np.zeros((k, k))
        langid.Field(list("abc"), None, np.empty(0), None, None, first, change).marginals(scores, begin, sizes, pairs)
        for x, y in itertools.product(range(k), repeat=2):
            step = np.zeros((k, k))
            step[x, y] = 1e-4
            slope = (_log_sum(change + step, first, scores, begin, sizes)
                     - _log_sum(change - step, first, scores, begin, sizes)) / 2e-4
            assert pairs[x, y] == pytest.approx(slope, abs=1e-6)


def test_held_out_accuracy_and_code_switching(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.QUERIES["op7_language"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(out) > 100 and sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    field = langid.fit(docs.where(~langid.held_out()))
    mixed = spark.createDataFrame([(1, "the and of that with this der die und nicht den von the of and to in")],
                                  "doc_id long, text string")
    runs = langid.predict(mixed, field, runs=True).head().runs
    assert [(r.word, r.words, r.lang) for r in runs] == [(0, 6, "en"), (6, 6, "de"), (12, 5, "en")]


def test_edge_cases(spark):
    docs = edge_cases.rows()
    got = langid.digest(edge_cases.table(spark)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    texts = {r[0]: r[1] for r in docs if r[0] not in (None, docs[7][0])}
    for r in got:
        if r.doc_id in texts:
            has = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert r.lang_pred == ("en" if has else "und") and (has or r.score == 0)
    assert langid.digest(edge_cases.table(spark, [])).count() == 0
    unlabelled = edge_cases.table(spark, [(*r[:2], None, *r[3:]) for r in docs])
    assert {(r.lang_pred, r.score) for r in langid.digest(unlabelled).collect()} == {("und", 0.0)}
    kept = langid.predict(edge_cases.table(spark), None, runs=True)
    assert kept.columns == [*edge_cases.table(spark).columns, "lang_pred", "score", "runs"] and kept.count() == len(docs)
