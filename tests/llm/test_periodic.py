"""Operator 11 against the definition of a run, lag by lag."""

import hashlib
import random
import re
import zlib

import numpy as np

from civicstream.llm import periodic, queries, textscan
from tests.llm import edge_cases


def runs(words):
    """Every run, by trying every period at every stretch."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, k, q) for (s, k), q in out.items())


def brute(rows):
    out = []
    for doc, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc).encode())
        if doc is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = runs(words)
        dropped = {i for s, k, q in found for i in range(s + q, s + k)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        out.append((doc, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def as_array(words):
    return np.unique(np.array(words), return_inverse=True)[1]


def listed(words, owner=None):
    owner = np.zeros(len(words), np.int64) if owner is None else owner
    return list(zip(*(x.tolist() for x in periodic.find(as_array(words), owner))))


def test_random_words_of_small_alphabets():
    rng = random.Random(5)
    for _ in range(600):
        words = [rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.randrange(1, 90))]
        assert listed(words) == runs(words)


def test_periods_of_every_scale_and_repeats_within_a_period():
    rng = random.Random(6)
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 129, 200]:
        for alphabet in (2, 50):
            unit = [rng.randrange(alphabet) for _ in range(q)]
            n = 4 * q + rng.randrange(3)
            words = [rng.randrange(100, 110) for _ in range(rng.randrange(9))]
            words += [unit[i % q] for i in range(n)]
            words += [rng.randrange(100, 110) for _ in range(rng.randrange(9))]
            words += [unit[i % q] for i in range(max(0, 4 * q - 1))]
            assert listed(words) == runs(words), q


def test_runs_end_with_their_text():
    words = [1, 2] * 10
    owner = np.repeat([0, 1], 10)
    assert listed(words, owner) == [(0, 10, 2), (10, 10, 2)]


def test_words_with_equal_hashes_are_told_apart():
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    buf = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    start, end, _ = textscan.spans(buf, np.array([0, len(buf)]), textscan.NOT_SPACE)
    number, first = textscan.names(buf, start, end)
    assert number[0] == number[2] != number[1] and len(first) == 2


def test_query_on_edge_cases(spark, tmp_dir):
    rng = random.Random(7)
    data = edge_cases.rows()
    for i in range(60):
        unit = edge_cases.words(rng, rng.randrange(1, 30), 6)
        data.append((1000 + i, " ".join([unit] * rng.randrange(1, 9)) + edge_cases.words(rng, 20), "en", "s", 1, "c", 1, 2, 3))
    edge_cases.write(edge_cases.table(spark, data), tmp_dir)
    got = queries.op11_periodic_runs(spark, tmp_dir)
    assert edge_cases.result(got) == brute([r[:2] for r in data])


def test_empty_table_and_other_columns(spark):
    docs = edge_cases.table(spark, [])
    assert periodic.digest(docs).collect() == []
    out = periodic.annotate(edge_cases.table(spark, [(1, "a b " * 5, "en", "s", 1, "c", 1, 2, 3)]).withColumnRenamed("n", "runs"))
    row = out.head()
    assert [tuple(r) for r in row.runs] == [(0, 10, 2)] and bytes(row.collapsed) == b"a b" and row.ids == "c"
