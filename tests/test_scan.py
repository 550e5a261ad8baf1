"""Scan building blocks: prefix scans, as-of lookup, size-checked broadcast."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicstream.operators.enrich import sized_broadcast
from civicstream.operators.scan import prefix_scan


def test_prefix_scan_matches_window(spark):
    rows = [(f"k{i % 3}", i, (i * 7) % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, v long").withColumn(
        "_chunk", F.floor(F.col("t") / 17))
    got = prefix_scan(df, ["k"], [F.col("t")], "_chunk",
                      [("s", "sum", F.col("v")), ("m", "max", F.col("v") * F.col("t"))])
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", F.sum("v").over(w).alias("s"), F.max(F.col("v") * F.col("t")).over(w).alias("m"))
    assert sorted(got.select("k", "t", "s", "m").collect()) == sorted(want.collect())


def test_sized_broadcast_only_under_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100).withColumnRenamed("id", "k")
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p1 = facts.join(sized_broadcast(small, max_rows=50), "k")._jdf.queryExecution() \
            .executedPlan().toString()
        p2 = facts.join(sized_broadcast(big, max_rows=50), "k")._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in p1
    assert "BroadcastHashJoin" not in p2
    wide = small.withColumn("text", F.repeat(F.lit("x"), 1000))
    assert sized_broadcast(wide, max_bytes=5000) is wide and sized_broadcast(wide, max_bytes=50_000) is not wide


def test_as_of_lookup_matches_brute_force(spark):
    import random
    from civicstream.operators.scan import last_before
    rnd = random.Random(3)
    tg = sorted({(rnd.choice("ab"), rnd.randrange(0, 5000), i) for i in range(300)})
    pr = [(rnd.choice("ab"), rnd.randrange(0, 5000), 10_000 + j) for j in range(200)]
    h = 400
    targets = spark.createDataFrame(tg, "k string, t_time long, t_tie long").withColumn(
        "t_val", F.col("t_tie"))
    probes = spark.createDataFrame(pr, "k string, p_time long, p_id long")
    back_in = probes.withColumn("p_tie", F.col("p_id"))
    back = {r.p_id: r.t_val for r in last_before(back_in, targets, ["k"], h).collect()}
    for k, p, pid in pr:
        cands = [(t, tie) for kk, t, tie in tg if kk == k and (t, tie) < (p, pid) and t >= p - h]
        assert back.get(pid) == (max(cands)[1] if cands else None)
