"""Bucketed running sum / previous value equal the plain window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from arbiter.operators.windows import previous_value, running_sum


def test_bucketed_windows_equal_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b"]), seq, rnd.randint(0, 3), rnd.choice(["x", "y", None]))
            for seq in rnd.sample(range(10_000), 3000)]
    df = spark.createDataFrame(rows, "k string, seq long, v long, s string")
    w = Window.partitionBy("k").orderBy("seq")
    exp = {(r.k, r.seq): (r.rs, r.pv) for r in df.select(
        "k", "seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.lag("s").over(w).alias("pv")).collect()}
    for width in (7, 64, 1 << 20):   # many buckets per key, and one
        rs = {(r.k, r.seq): r.rs for r in running_sum(df, ["k"], "seq", "v", "rs", width).collect()}
        pv = {(r.k, r.seq): r.pv for r in previous_value(df, ["k"], "seq", "s", "pv", width).collect()}
        assert rs == {k: v[0] for k, v in exp.items()}
        assert pv == {k: v[1] for k, v in exp.items()}


def test_ranges_follow_the_rows_not_the_span(spark):
    from arbiter.operators.windows import next_min, range_width
    dense = spark.range(2000).union(spark.range(10 ** 15, 10 ** 15 + 1))
    width = range_width(dense, "id", 100)
    assert dense.selectExpr(f"id div {width}").distinct().count() > 15     # one far id does not widen them
    sparse = spark.range(2000).selectExpr("id * 1000000007 as id")
    width = range_width(sparse, "id", 100)
    assert 1 < sparse.selectExpr(f"id div {width}").distinct().count() <= 80   # nor is a row a range
    assert range_width(spark.range(0), "id") == 1 << 20
    df = spark.createDataFrame([("k", i, i if i % 7 == 3 else None) for i in range(100)], "k string, seq long, v long")
    for w in (1, 9, 1 << 20):
        got = {r.seq: r.n for r in next_min(df, ["k"], "seq", "v", "n", w).collect()}
        assert got == {i: next((j for j in range(i + 1, 100) if j % 7 == 3), None) for i in range(100)}
