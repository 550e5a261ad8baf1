"""Operator 2 against counting in Python."""

import re

from pyspark.sql import functions as F

from civicstream.llm import quality
from tests.llm import edge_cases


def counts(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    hit = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)),
            len(hit))


def more_rows():
    w = [f"q{i}" for i in range(40)]
    extra = ["a b " * 20, " ".join(w + w[:9]), " ".join(w + ["x"] + w[5:14] + w[7:16]), "\n".join(["same line"] * 12),
             "#### | <> " * 8, " ".join(["a"] * 7), " ".join(["a"] * 8), " ".join(["a"] * 9)]
    return edge_cases.rows() + [(5000 + i, t, "en", "s0", 0, None, None, None, None) for i, t in enumerate(extra)]


def test_counts_and_base_rule(spark):
    data = more_rows()
    got = [tuple(r)[:7] for r in quality.digest(edge_cases.table(spark, data)).collect()]
    expected = []
    for r in data:
        c = counts(r[1])
        expected.append((r[0], *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert quality.digest(edge_cases.table(spark, [])).count() == 0


def test_sketches_merge(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "id % 3 as g", "repeat('word ', cast(20 + id % 70 as int)) || "
                                      "repeat('# ', cast(id % 37 as int)) as text")
    m = quality.metrics(df).withColumn("n_repeat_words", F.lit(0))
    whole = quality.sketch(m, ["g"])
    parts = quality.merge(quality.sketch(m.where("doc_id < 1000"), ["g"]), quality.sketch(m.where("doc_id >= 1000"), ["g"]))
    assert edge_cases.result(whole) == edge_cases.result(parts.select(whole.columns))


def test_outliers_of_a_group_go_and_common_habits_stay(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    noisy = clean.replace(" word5", " ### word5")
    rows = [(i, clean, "en", "calm") for i in range(40)] + [(99, noisy, "en", "calm")] + \
        [(200 + i, noisy, "en", "loud") for i in range(40)]
    got = {r.doc_id: r.kept for r in quality.digest(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [d for d, kept in got.items() if not kept] == [99]


def test_fences_follow_the_tails_of_the_group(spark):
    """The verdict by sorted lists of all values; every bucket of values below 128 is one value."""
    rows = [(i, " ".join(["word"] * 3 + [f"w{i}x{j}" for j in range(97)]).replace("word", "#" * (1 + i % 20) + "wor"),
             "en", "wide" if i % 2 else "odd") for i in range(200)]
    rows += [(900 + i, " ".join(f"w{i}x{j}" for j in range(90)) + " " + "#" * (20 * i), "en", "wide") for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    signal = {}
    for d, text, _, source in rows:
        n, chars, symbols, *_ = counts(text)
        signal[d] = (source, 1000 * symbols // chars, 100 * chars // n)

    def low(v):
        return v >> max(0, v.bit_length() - 7) << max(0, v.bit_length() - 7)

    def inside(d, which, least):
        own = sorted(low(x[which]) for x in signal.values() if x[0] == signal[d][0])
        q10, q50, q90 = (own[-(-k * len(own) // 10) - 1] for k in (1, 5, 9))
        return q10 - 3 * max(q50 - q10, least) <= signal[d][which] <= q90 + 3 * max(q90 - q50, least)

    expected = {d: inside(d, 1, 5) and inside(d, 2, 10) for d in signal}
    assert {r.doc_id: r.kept for r in quality.digest(table).collect()} == expected
    assert 0 < sum(not k for k in expected.values()) < 12
    report = {r.signal: r[1:] for r in quality.floor_decides(quality.sketch(
        quality.metrics(table), ["lang", "source"]), ["lang", "source"]).collect()}
    assert report["symbols_pm"] == (2, 0, 0) and report["dup_lines_pm"] == (2, 2, 2)


def test_no_python_in_the_plan(spark):
    plan = quality.digest(edge_cases.table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
