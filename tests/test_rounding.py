import random

from arbiter.functions.rounding import exact_round, exact_round_sql
from arbiter.functions.rules import exact_mean


def test_exact_round_matches_python(spark):
    random.seed(7)
    vals = [0.62315, 0.24115, 0.1625, 0.5795, 2.675, -2.675, -0.62315, 0.0, 0.5, 1.5, 2.5, -0.5]
    vals += [random.randint(0, 10 ** 6) / 10 ** random.choice([3, 4, 5, 6]) for _ in range(1500)]
    vals += [random.uniform(-1e4, 1e4) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for n in (1, 2, 3, 4, 6):
        by_col = [r[0] for r in df.select(exact_round(df.x, n)).collect()]
        by_sql = [r[0] for r in df.select(exact_round("x", n)).collect()]
        exp = [round(v, n) + 0.0 for v in vals]
        assert by_col == exp
        assert by_sql == exp


def test_exact_round_sql_in_duckdb():
    import duckdb
    vals = [0.62315, 0.24115, 0.1625, 2.675, -0.62315, 1e-7, 123456.7891235]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    got = [r[0] for r in con.execute(f"SELECT {exact_round_sql('x', 4)} FROM t ORDER BY i").fetchall()]
    assert got == [round(v, 4) + 0.0 for v in vals]


def test_exact_mean_is_partition_independent(spark):
    random.seed(3)
    vals = [(random.randint(0, 1000) / 1000.0,) for _ in range(5000)]
    df = spark.createDataFrame(vals, "score double")
    a = df.repartition(1).agg(exact_mean("score", 3)).first()[0]
    b = df.repartition(13).agg(exact_mean("score", 3)).first()[0]
    exact = sum(int(round(v[0] * 1000)) for v in vals) / (1000.0 * len(vals))
    assert a == b == exact
