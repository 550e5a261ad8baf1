"""Operator 10 against all pairs of documents."""

import random
import re

import numpy as np

from civicstream.llm import queries, setsketch
from civicstream.llm.components import components
from tests.llm import edge_cases


def shingles(text, size=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    if 0 < len(w) < size:
        return {tuple(w)}
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs):
    """Rows of the operator; pairs are found by an exact inverted index."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    classes, where = {}, {}
    for i, s in enumerate(sets):
        if s:
            classes.setdefault(frozenset(s), []).append(i)
    for same in classes.values():
        for i in same:
            root[find(i)] = find(same[0])
    reps = [same[0] for same in classes.values()]
    for i in reps:
        count = {}
        for x in sets[i]:
            for j in where.get(x, ()):
                count[j] = count.get(j, 0) + 1
            where.setdefault(x, []).append(i)
        for j, n in count.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(docs[i][0])
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [x for x in groups[find(i)] if x is not None] if sets[i] else [doc]
        least = min(ids) if ids else None
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def test_edge_cases(spark):
    docs = edge_cases.rows()
    got = edge_cases.result(setsketch.near_duplicates(edge_cases.table(spark)))
    assert got == brute([r[:2] for r in docs])
    assert setsketch.near_duplicates(edge_cases.table(spark, [])).count() == 0


def test_chains_and_crowded_groups(spark):
    """A text changes bit by bit along a chain, so that only neighbours are linked; many copies
    of one text differ from it, and more from each other, at similarities around the threshold."""
    rng = random.Random(5)
    docs, w = [], [f"c{rng.randrange(9999)}" for _ in range(100)]
    for i in range(30):
        docs.append((1000 - i, " ".join(w)))
        w = w.copy()
        for _ in range(2):
            w[rng.randrange(100)] = f"x{rng.randrange(9999)}"
    base = [f"b{rng.randrange(9999)}" for _ in range(120)]
    for i in range(150):
        copy = base.copy()
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            copy[rng.randrange(120)] = f"y{rng.randrange(9999)}"
        docs.append((2000 + i, " ".join(copy)))
    got = edge_cases.result(setsketch.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert edge_cases.result(queries.QUERIES["op10_near_dedup"](spark, folder)) == brute(docs)


def test_registers_merge_and_estimate():
    rng = np.random.Generator(np.random.PCG64(1))
    one, two = rng.integers(0, 2**63, (2, 800), dtype=np.uint64)
    both = np.concatenate([one, two])
    r = setsketch.registers(np.concatenate([one, two, both]), np.array([800, 800, 1600]))
    assert (np.maximum(r[0], r[1]) == r[2]).all()
    n = np.array([1000.0])
    for shared, expected in ((890, True), (0, False), (300, False)):
        a, b = rng.integers(0, 2**63, (2, 1000), dtype=np.uint64)
        b[:shared] = a[:shared]
        ra, rb = setsketch.registers(np.concatenate([a, b]), np.array([1000, 1000]))
        assert setsketch.plausible(ra[None], rb[None], n, n, 0.8)[0] == expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (500, 500), (300, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
