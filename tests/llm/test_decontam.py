"""Operator 3 against a search of every window in every document."""

import hashlib
import re

from pyspark.sql import types as T

from civicstream.llm import decontam
from tests.llm import edge_cases

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("fp", T.StringType())])


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(text)


def brute(docs, items):
    wins = {}
    for item, text, _ in items:
        w = words(text)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[p:p + n]), set()).add("" if item is None else str(item))
    out = []
    for r in docs:
        w, hit, found = words(r[1]), set(), set()
        for n in range(1, 11):
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p:p + n])) in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[g]
        out.append((r[0], len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_for(docs):
    base = docs[5][1].split()
    return [(1, " ".join(base[3:30]), "x"), (2, " ".join(base[10:20]).upper(), None), (10, "one two three", None),
            (11, "one", None), (12, None, None), (13, "", None), (14, "!!", None), (None, "changed " * 2, None),
            (2, " ".join(base[60:75]), None), (15, " ".join(docs[9][1].split()[7000:7011]), None),
            (16, "été " * 12, None), (17, "no such words at all in any of the documents of this", None)]


def test_edge_cases(spark):
    docs = edge_cases.rows()
    items = items_for(docs)
    got = decontam.digest(edge_cases.table(spark), spark.createDataFrame(items, ITEMS))
    expected = brute(docs, items)
    assert edge_cases.result(got) == expected and sum(r[5] for r in expected) >= 5


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontam.digest(edge_cases.table(spark, []), none).count() == 0
    assert not decontam.digest(edge_cases.table(spark), none).where("contaminated").count()


def test_every_overlap_of_a_window_is_found(spark):
    """A shared span of exactly the window's length shares a fingerprint wherever it begins."""
    item = " ".join(f"a{i}" for i in range(40))
    docs = [(i, f"x{i} " * (i % 7) + " ".join(f"a{j}" for j in range(i, i + 10)) + f" y{i}") for i in range(31)]
    docs += [(100 + i, f"x{i} " + " ".join(f"a{j}" for j in range(i, i + 9)) + f" y{i}") for i in range(31)]
    got = {r.doc_id: r.n_hit for r in decontam.report(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(0, item, None)], ITEMS)).collect()}
    assert got == {i: 10 for i in range(31)} | {100 + i: 0 for i in range(31)}


def test_clean_keeps_columns_and_rows(spark):
    docs = edge_cases.rows()
    items = items_for(docs)
    kept = decontam.clean(edge_cases.table(spark), spark.createDataFrame(items, ITEMS))
    assert kept.columns == edge_cases.table(spark).columns
    assert kept.count() == sum(not r[5] for r in brute(docs, items))
