"""Operator 9 against a table of all runs."""

import hashlib
import random
import re

import pytest

from civicstream.llm import linededup
from tests.llm import edge_cases

WORD = re.compile("[^\x20\x09-\x0d]")


def lost_lines(docs, k=3, least=50):
    """Lines that each text of (order, text) loses, by its place in ``docs``."""
    seen, lost = set(), [set() for _ in docs]
    for i in sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0)):
        own = [(p, x) for p, x in enumerate((docs[i][1] or "").split("\n")) if WORD.search(x)]
        for size in [*range(1, min(k, 3)), k]:
            for j in range(len(own) - size + 1):
                run = tuple(x for _, x in own[j:j + size])
                if size == k or (least and sum(len(re.findall("[^\x20\x09-\x0d]+", x)) for x in run) >= least):
                    if run in seen:
                        lost[i].update(p for p, _ in own[j:j + size])
                    seen.add(run)
    return lost


def brute(docs, k=3):
    out = []
    for (d, t), gone in zip(docs, lost_lines(docs, k)):
        lines = (t or "").split("\n")
        n = sum(bool(WORD.search(x)) for x in lines)
        rest = "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append((d, n, len(gone), not (gone and len(gone) == n), hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_docs(seed=1):
    rng = random.Random(seed)
    docs = []
    for i in range(80):
        lines = [rng.choice(["aa", "bb b", "cc", "", "  ", f"l{rng.randrange(30)}", "é"]) for _ in range(rng.randrange(14))]
        if docs and rng.random() < 0.4:
            lines[2:2] = rng.choice(docs)[1].split("\n")
        docs.append((i, "\n".join(lines)))
    return docs + [(500, "\n".join(["same"] * 12)), (501, "x\ny\nz"), (502, "w\nx\ny\nz")]


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_runs_of_any_length(spark, k):
    docs = some_docs(k)
    got = linededup.remove_repeated_runs(spark.createDataFrame(docs, "doc_id long, text string"), k)
    rows = [(r.doc_id, r.n_lines, r.n_removed, not r.emptied, hashlib.sha256(r.text.encode()).hexdigest())
            for r in got.collect()]
    assert sorted(rows, key=repr) == brute(docs, k)


def test_edge_cases(spark):
    data = edge_cases.rows()
    data.append((7000, "p q\nr s\n\nt u\nv", *data[0][2:]))
    data.append((7001, "0\np q\nr s\nt u\n9", *data[0][2:]))
    got = linededup.digest(edge_cases.table(spark, data))
    assert edge_cases.result(got) == brute([r[:2] for r in data])
    assert linededup.digest(edge_cases.table(spark, [])).count() == 0
    df = edge_cases.table(spark, data)
    assert linededup.remove_repeated_runs(df).columns == [*df.columns, "n_lines", "n_removed", "emptied"]
    assert linededup.remove_repeated_runs(df).where("text is null").count() == 2


def test_a_repeated_row_loses_its_runs_once(spark):
    docs = [(1, "a\nb\nc\nd")] * 3
    got = linededup.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) == [0, 4, 4]


def test_no_python_in_the_plan(spark):
    plan = linededup.digest(edge_cases.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("k", [2, 3, 4])
def test_long_passages_on_one_or_two_lines(spark, k):
    rng = random.Random(k)
    pool = [" ".join(f"w{rng.randrange(99)}" for _ in range(n)) for n in (3, 20, 25, 25, 30, 49, 50, 70)]
    pool += ["\t" + pool[6].replace(" ", " \x0b ") + " ", "", " ", "one"]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own {i} {j}" for j in range(rng.randrange(7))))
            for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (50, None):
        got = linededup.remove_repeated_runs(table, k, long_words=least)
        assert sorted((r.doc_id, r.text) for r in got.collect()) == [
            (d, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone))
            for (d, t), gone in zip(docs, lost_lines(docs, k, least))]


def test_passage_of_fifty_words_on_one_line_in_the_query(spark):
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    docs = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, f"e\n{short}\nf"), (4, f"g\n{short}\nh")]
    got = linededup.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 1), (3, 0), (4, 0)]
