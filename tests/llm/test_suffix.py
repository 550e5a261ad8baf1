"""Operator 6 against a table of every string of the given length."""

import hashlib
import random

import numpy as np
import pytest

from civicstream.llm import hashstore, queries, suffix
from tests.llm import edge_cases


def brute(docs, length=200):
    seen = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for _, b in raw:
        for p in range(len(b) - length + 1):
            h = hash(b[p:p + length])
            seen[h] = seen.get(h, 0) + 1
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[hash(b[p:p + length])] > 1:
                gone[p:p + length] = b"\1" * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [1, 7, 11, 20, 50, 100, 200, 300])
def test_cover_reaches_every_pair_of_positions(length):
    v, cover = suffix.difference_cover(length)
    for d in range(v):
        assert any((x + d) % v in cover for x in cover)
    assert length - v + 1 >= length // 3


def test_edge_cases(spark):
    docs = edge_cases.rows()
    assert edge_cases.result(suffix.digest(edge_cases.table(spark))) == brute([r[:2] for r in docs])
    assert suffix.digest(edge_cases.table(spark, [])).count() == 0
    out = suffix.remove_repeated(edge_cases.table(spark))
    assert {"rid", "lang", "ids", "n_removed"} <= set(out.columns)


@pytest.mark.parametrize("length", [5, 20, 60])
def test_short_strings(spark, length):
    rng = random.Random(length)
    docs = []
    for i in range(120):
        parts = ["".join(rng.choices("abé ", k=rng.randrange(0, 60))) for _ in range(3)]
        if docs and rng.random() < 0.6:
            other = rng.choice(docs)[1]
            at = rng.randrange(len(other) + 1)
            parts.insert(1, other[at:at + rng.randrange(length, 3 * length)])
        docs.append((i, "".join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffix.remove_repeated(df, length=length)
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept_bytes)).hexdigest())
            for r in got.collect()]
    assert sorted(rows, key=repr) == brute(docs, length)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert edge_cases.result(queries.QUERIES["op6_suffix_dedup"](spark, folder)) == brute(docs)


def test_packed_keys_come_back():
    rng = np.random.Generator(np.random.PCG64(2))
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (hashstore._keys(hashstore._steps(keys)) == keys).all()
    keys = np.array([0, 1, 2**64 - 1], np.uint64)
    assert (hashstore._keys(hashstore._steps(keys)) == keys).all()
    rows = [r for b in hashstore.packed(keys, np.array([1, 300, 2**40]), 4) for r in b.to_pylist()]
    assert [r["shard"] for r in rows] == [0, 15]
    k, c = hashstore.merged([(r["keys"], r["counts"]) for r in rows for _ in range(2)])
    assert (k == keys).all() and c.tolist() == [2, 600, 2**41]
