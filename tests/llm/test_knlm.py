"""Operator 5 against a dictionary-based Kneser-Ney model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from civicstream.llm import hashstore, knlm, queries, textscan
from tests.llm import edge_cases


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", text) + ["</s>"]


class Reference:
    def __init__(self, texts):
        self.c, self.pair = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            self.pair.update(zip(["<s>", *w[:-1]], w))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.cont = Counter(w for _, w in self.pair)
        self.total = Counter()
        self.kinds = {}
        for (u, _), n in self.pair.items():
            self.total[u] += n
            self.kinds.setdefault(u, Counter())[min(n, 3)] += 1
        self.d2 = self.discounts(self.pair.values())
        self.d1 = self.discounts(self.cont.values())
        self.rest = sum(self.d1[min(n, 3)] for n in self.cont.values()) / max(len(self.pair), 1)

    @staticmethod
    def discounts(counts):
        return knlm._discounts([sum(c == i for c in counts) for i in (1, 2, 3, 4)])

    def low(self, w):
        t = len(self.pair)
        if not t:
            return 1 / (self.v + 1)
        rest = self.rest
        n = self.cont[w]
        return max(n - self.d1[min(n, 3)], 0) / t + rest / (self.v + 1)

    def p(self, u, w):
        if not self.total[u]:
            return self.low(w)
        n = self.pair[u, w]
        back = sum(self.d2[k] * m for k, m in self.kinds[u].items()) / self.total[u]
        return max(n - self.d2[min(n, 3)], 0) / self.total[u] + back * self.low(w)

    def row(self, doc, out, text):
        w = tokens(text)
        base = sum(math.log10((self.c[x] + 1) / (self.n + self.v + 1)) for x in w)
        score = sum(math.log10(self.p(u, x)) for u, x in zip(["<s>", *w[:-1]], w))
        return (doc, out, len(w), sum(self.c[x] > 0 for x in w), self.n, base, score)


def is_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Reference3(Reference):
    """Order 3 by dictionaries: raw counts on top, continuation counts below."""

    def __init__(self, texts):
        super().__init__(texts)
        self.triple = Counter()
        for t in texts:
            w = ["<s>", *tokens(t)]
            self.triple.update(zip(w, w[1:], w[2:]))
        self.context, self.kinds3 = Counter(), {}
        for (t, u, _), n in self.triple.items():
            self.context[t, u] += n
            self.kinds3.setdefault((t, u), Counter())[min(n, 3)] += 1
        self.before = Counter((u, w) for _, u, w in self.triple)
        self.before.update({x: n for x, n in self.pair.items() if x[0] == "<s>"})
        self.total2, self.kinds2 = Counter(), {}
        for (u, _), n in self.before.items():
            self.total2[u] += n
            self.kinds2.setdefault(u, Counter())[min(n, 3)] += 1
        self.d3, self.dc = self.discounts(self.triple.values()), self.discounts(self.before.values())

    def middle(self, u, w):
        if not self.total2[u]:
            return self.low(w)
        n = self.before[u, w]
        back = sum(self.dc[k] * m for k, m in self.kinds2[u].items()) / self.total2[u]
        return max(n - self.dc[min(n, 3)], 0) / self.total2[u] + back * self.low(w)

    def p3(self, t, u, w):
        if not self.context[t, u]:
            return self.middle(u, w)
        n = self.triple[t, u, w]
        back = sum(self.d3[k] * m for k, m in self.kinds3[t, u].items()) / self.context[t, u]
        return max(n - self.d3[min(n, 3)], 0) / self.context[t, u] + back * self.middle(u, w)

    def score3(self, text):
        w = ["<s>", *tokens(text)]
        return math.log10(self.middle(*w[:2])) + sum(math.log10(self.p3(*x)) for x in zip(w, w[1:], w[2:]))

    def row(self, doc, out, text):
        return (*super().row(doc, out, text)[:6], self.score3(text))


def check(got, docs):
    model = Reference3([t for d, t in docs if not is_out(d)])
    expected = sorted((model.row(d, is_out(d), t) for d, t in docs), key=lambda r: (repr(r[0]), r[2], r[5]))
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (repr(r[0]), r[2], r[5]))
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5] and g[5:7] == pytest.approx(e[5:], rel=1e-9)
        assert g[7] == pytest.approx(10 ** (-e[6] / e[2]), rel=1e-9)
    return model, expected


def test_edge_cases(spark):
    check(knlm.digest(edge_cases.table(spark)), [r[:2] for r in edge_cases.rows()])
    assert knlm.digest(edge_cases.table(spark, [])).count() == 0


def test_without_training_rows(spark):
    out = next(i for i in range(1000) if is_out(i))
    check(knlm.digest(spark.createDataFrame([(out, "some words")], "doc_id long, text string")), [(out, "some words")])


def test_probabilities_sum_to_one():
    model = Reference(["a b a c", "b b a", "c a b a b", None, "d"])
    for u in ["<s>", "a", "b", "c", "d", "never"]:
        assert sum(model.p(u, w) for w in [*model.c, "<unknown>"]) == pytest.approx(1)


def test_mix_is_undone():
    x = np.random.Generator(np.random.PCG64(1)).integers(0, 2**64, 1000, dtype=np.uint64)
    assert (knlm._unmix(textscan.mix(x)) == x).all()


def test_query_beats_order_2_and_the_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    model, rows = check(queries.QUERIES["op5_kneser_ney"](spark, folder), docs)
    base, three = (sum(r[k] for r in rows if r[1]) for k in (5, 6))
    two = sum(Reference.row(model, d, True, t)[6] for d, t in docs if is_out(d))
    assert three > two > base


def test_order_3_edge_cases(spark):
    data = [r[:2] for r in edge_cases.rows()] + [(9000 + i, t) for i, t in enumerate(
        ["a b c a b d", "a b c a b c", "never seen b c", "b c a b", "a", "a b", "c a b never", "B c A b d"] * 3)]
    check(knlm.digest(spark.createDataFrame(data, "doc_id long, text string")), data)
    out = next(i for i in range(1000) if is_out(i))
    alone = [(out, "some words"), (out, None)]
    check(knlm.digest(spark.createDataFrame(alone, "doc_id long, text string")), alone)


def test_order_3_sums_to_one():
    model = Reference3(["a b a c", "b b a", "c a b a b", None, "d"])
    for u in ["<s>", "a", "b", "c", "d", "never"]:
        assert sum(model.middle(u, w) for w in [*model.c, "<unknown>"]) == pytest.approx(1)
        for t in ["<s>", "a", "b", "never"]:
            assert sum(model.p3(t, u, w) for w in [*model.c, "<unknown>"]) == pytest.approx(1)


@pytest.mark.parametrize("n,top", [(1, 64), (2, 64), (3, 8), (50, 6), (1000, 64), (1001, 40), (5000, 64), (20000, 58), (40000, 58)])
def test_packed_keys_come_back(n, top):
    rnd = np.random.default_rng(n)
    keys = np.unique(rnd.integers(0, 2**top - 1, n, dtype=np.uint64))
    assert np.array_equal(hashstore._keys(hashstore._steps(keys)), keys)
    ends = np.unique(np.concatenate([keys, np.array([0, 2**64 - 1], np.uint64)]))
    assert np.array_equal(hashstore._keys(hashstore._steps(ends)), ends)


def test_packed_hashes_take_few_bytes():
    """A few wide steps do not make all others wide: 49152 hashes of a range of 2^58 have steps of 43 bits on
    average, the widest of 46."""
    keys = np.unique(np.random.default_rng(1).integers(0, 2**58, 49152, dtype=np.uint64))
    assert len(hashstore._steps(keys)) < 5.65 * len(keys)
