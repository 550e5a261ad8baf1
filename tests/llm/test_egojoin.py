"""Operator 12 against all pairs."""

import math
import random

import numpy as np
import pytest

from civicstream.llm import egojoin, queries
from tests.llm import edge_cases


def brute(rows, least=0.95):
    sizes = [len(v) for _, v in rows if v]
    width = max(set(sizes), key=lambda n: (sizes.count(n), n)) if sizes else 0
    proper = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) == width
              and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    if not proper:
        return sorted(((vec, 0, vec, True) for vec, _ in rows), key=repr)
    x = np.array([rows[i][1] for i in proper], float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    root = np.arange(len(proper))
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=len(root))) for i in range(len(root))], int)
        if (new == root).all():
            break
        root = new
    out = []
    for i, (vec, _) in enumerate(rows):
        n, ids = 0, [vec]
        if i in proper:
            k = proper.index(i)
            n, ids = int(linked[k].sum()), [rows[proper[j]][0] for j in np.flatnonzero(root == root[k])]
        first = min((v for v in ids if v is not None), default=None)
        out.append((vec, n, first, vec == first))
    return sorted(out, key=repr)


def table(spark, rows, kind="float"):
    rows = [(i, v and [x if x is None else float(x) for x in v], 1, 2) for i, v in rows]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, h1 int, n int")


def clustered(seed, n, width, spread, groups):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    x = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, width))
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in zip(rng.permutation(n), x)]


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(egojoin, "BLOCK", 16)
    monkeypatch.setattr(egojoin, "FAN", 4)
    monkeypatch.setattr(egojoin, "FAN_BITS", 2)


def test_edge_cases(spark):
    rng = random.Random(2)
    base = [rng.random() for _ in range(6)]
    near = [x + 0.01 for x in base]
    rows = [(5, base), (3, near), (9, [2.0 * x for x in base]), (7, base), (7, base), (None, base), (4, None), (8, []),
            (10, [0.0] * 6), (11, [None] + base[1:]), (12, [math.nan] + base[1:]), (13, [math.inf] + base[1:]),
            (14, base[:5]), (15, [-x for x in base]), (None, [1.0, 0, 0, 0, 0, 0]), (16, [1e30] * 6), (17, [1e-40] * 6),
            (2, [1.0, 0, 0, 0, 0, 1e-20]), (7, [0, 1.0, 0, 0, 0, 0])]
    assert edge_cases.result(egojoin.near_duplicates(table(spark, rows, "double"))) == brute(rows)


def test_many_blocks_and_levels(spark, small_blocks):
    for seed, spread in ((1, 0.15), (2, 0.02)):
        rows = clustered(seed, 700, 8, spread, 25)
        rows += [(2000 + i, rows[0][1]) for i in range(90)]              # copies of one vector
        assert edge_cases.result(egojoin.near_duplicates(table(spark, rows))) == brute(rows)


def test_a_dense_group_is_linked_as_a_whole(spark, small_blocks, monkeypatch):
    rows = clustered(3, 600, 8, 0.001, 1)
    compared = []
    plain = egojoin._compared
    monkeypatch.setattr(egojoin, "_compared", lambda pairs, *a: compared.append(pairs.count()) or plain(pairs, *a))
    assert edge_cases.result(egojoin.near_duplicates(table(spark, rows))) == brute(rows)
    assert compared == [0]


def test_distant_blocks_are_skipped(spark, small_blocks, monkeypatch):
    rng = np.random.default_rng(4)
    angle = np.sort(rng.uniform(0, 2 * np.pi, 800))
    rows = [(i, [float(np.float32(np.cos(t))), float(np.float32(np.sin(t)))]) for i, t in enumerate(angle)]
    compared = []
    plain = egojoin._compared
    monkeypatch.setattr(egojoin, "_compared", lambda pairs, *a: compared.append(pairs.count()) or plain(pairs, *a))
    assert edge_cases.result(egojoin.near_duplicates(table(spark, rows))) == brute(rows)
    assert compared[0] < 0.4 * 50 * 51 / 2


def test_empty_and_improper_tables(spark):
    assert egojoin.near_duplicates(table(spark, [])).collect() == []
    rows = [(1, None), (2, [0.0]), (None, [])]
    assert edge_cases.result(egojoin.near_duplicates(table(spark, rows))) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert edge_cases.result(queries.op12_vector_dedup(spark, sf)) == brute(rows)
