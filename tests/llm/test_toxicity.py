"""Operator 4: held-out accuracy, a pair that no single word explains, edge cases."""

import random

import numpy as np
import pyarrow as pa

from civicstream.llm import queries, toxicity
from tests.llm import edge_cases


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.QUERIES["op4_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in rows if not r.toxic) / (len(rows) - len(toxic)) < 0.01


def test_pairs_count_beyond_their_words():
    """An insult at a group is toxic, either alone is not."""
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(1200):
        words = [f"w{rng.randrange(60)}" for _ in range(8)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insulting"] * insult + ["outgroup"] * group
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(float(insult and group))
    column = pa.array(texts)
    known = np.unique(toxicity.Terms(column).hashes)
    text, feature = toxicity.Terms(column).features(known)
    machine = toxicity.train(known, np.array(labels), [feature[text == i] for i in range(len(texts))])
    rest = " ".join(f"w{i}" for i in range(0, 56, 7))
    s = machine.score(pa.array([f"{rest} insulting outgroup", f"{rest} insulting", f"{rest} outgroup", rest]))
    assert s[0] > 0.5 > max(s[1:])
    # what the pair adds beyond its words, in the score before the logistic function
    margin = np.log(s / (1 - s)) - np.log(s[3] / (1 - s[3]))
    assert margin[0] > margin[1] + margin[2] + 1


def test_edge_cases(spark):
    docs = edge_cases.table(spark)
    labels = spark.createDataFrame([(0, 1), (0, None), (None, 1), (3, 0), (100, 0), (200, 0), (3, 1), (400, 0),
                                    (700, 0), (9, 1), (99999, 1)], "doc_id long, toxic int")
    got = toxicity.digest(docs, labels).collect()
    assert len(got) == len(edge_cases.rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    none = labels.limit(0)
    assert max(r.score for r in toxicity.digest(docs, none).collect()) < 1e-8
    only = toxicity.digest(docs, spark.createDataFrame([(3, 1), (1, 1), (6, 1)], labels.schema)).collect()
    assert min(r.score for r in only) > 0.5
    assert toxicity.digest(edge_cases.table(spark, []), labels).count() == 0
