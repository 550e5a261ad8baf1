"""Operator 13 against counts of all phrases in plain dictionaries."""

import re
from collections import Counter

import numpy as np

from civicstream.llm import phrases, queries
from tests.llm import edge_cases


def brute(rows, support=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, w[i:i + k]] += 1
    found = {k: c for k, c in f.items() if c >= support}
    longer = Counter()
    for (lang, w), c in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                key = lang, w[i:i + size]
                longer[key] = max(longer[key], c)
    out = {}
    for (lang, w), a in found.items():
        if len(w) == 1 or longer[lang, w] and 100 * longer[lang, w] >= 80 * a:
            continue
        score, k = min((2000000 * a // (found[lang, w[:k]] + found[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), found[lang, w[:k]], found[lang, w[k:]]))
    rows = []
    for lang, best in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(rows, key=repr)


def test_edge_cases_at_low_support(spark):
    data = edge_cases.rows()
    data += [(500 + i, "A tie. B tie, c tie! a TIE; b tie", f"l{i % 2}", "s", 1, "c", 1, 2, 3) for i in range(4)]
    for support, top in ((1, 2000), (2, 5), (3, 2000)):
        got = phrases.collocations(edge_cases.table(spark, data), support, top)
        assert edge_cases.result(got) == brute([(r[1], r[2]) for r in data], support, top)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()
    expected = brute([tuple(r) for r in docs])
    assert expected and edge_cases.result(queries.op13_phrases(spark, sf)) == expected


def test_local_supports_find_every_frequent_phrase(spark):
    """A phrase that is rare in most shards, in languages of very unequal size."""
    data = [(i, "rare pair here" if i % 40 == 0 else "common words again and again", "big" if i % 5 else "small",
             "s", 1, "c", 1, 2, 3) for i in range(1300)]
    got = phrases.collocations(edge_cases.table(spark, data))
    assert edge_cases.result(got) == brute([(r[1], r[2]) for r in data])
    least = phrases._supports(spark.createDataFrame([("a", 0, 70), ("a", 1, 30), ("b", 3, 5)], "lang string, shard int, n long"), 30)
    assert sorted(np.unique(least).tolist()) == [1, 9, 21, 30]


def test_empty_table(spark):
    assert phrases.digest(edge_cases.table(spark, [])).collect() == []
