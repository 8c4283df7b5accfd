from pyspark.sql import functions as F

from arbiter.operators import ml as ML
from arbiter.operators import ranking as RK
from arbiter.sources import fixtures as FX
from arbiter.sources import sinks
from arbiter.operators import compare as CP
from conftest import SF_SMALL


def test_splits_are_disjoint_exhaustive_and_stable(spark):
    t = FX.tabular(spark, SF_SMALL)
    a = t.select("row_id", ML.split_label("row_id").alias("s"))
    b = t.repartition(7).select("row_id", ML.split_label("row_id").alias("s"))
    assert a.count() == t.count()
    assert a.groupBy("row_id").agg(F.countDistinct("s").alias("k")).where("k > 1").count() == 0
    assert sorted(a.collect()) == sorted(b.collect())
    shares = {r.s: r.c for r in a.groupBy("s").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert set(shares) == {"train", "val", "test"}


def test_sample_is_shared_and_repeatable(spark):
    r = FX.responses(spark, SF_SMALL).select("template", "resp_id")
    s1 = RK.seeded_sample(r, "resp_id", 3, partition_cols=["template"]).collect()
    s2 = RK.seeded_sample(r.repartition(5), "resp_id", 3, partition_cols=["template"]).collect()
    assert sorted(s1) == sorted(s2)


def test_audit_is_append_only(spark):
    path = sinks.fresh_path(spark, "audit-test")
    cands = spark.createDataFrame([("m", "2", None, "abcdef123456", "t", "1.0", "x")],
                                  "model string, version string, prev_version string, git_sha string, "
                                  "template_name string, template_version string, llm_model string")
    sinks.append_audit(CP.audit_rows(cands, "2024-01-01", "me"), path)
    first = sorted(sinks.read_audit(spark, path).collect())
    sinks.append_audit(CP.audit_rows(cands, "2024-01-02", "me"), path)
    second = sorted(sinks.read_audit(spark, path).collect())
    assert len(second) == 2 and all(r in second for r in first)


def test_promotion_boundary_is_strict(spark):
    sides = spark.createDataFrame([("m", 0.50, 0.52, 0.0, 0.0, 0.0, 0.0), ("n", 0.50, 0.52000001, 0.0, 0.0, 0.0, 0.0),
                                   ("o", 0.5, 0.51, 0.0, 0.0, 0.0, 0.0)],
                                  "model string, champ_composite double, chall_composite double, "
                                  "champ_avg_latency_ms double, chall_avg_latency_ms double, "
                                  "champ_avg_cost_usd double, chall_avg_cost_usd double")
    got = {r.model: r.promote for r in CP.promotion_decision(sides).collect()}
    # 0.52 - 0.50 > 0.02 is true in binary floating point, as in the reference
    assert got == {"m": (0.52 - 0.50) > 0.02, "n": True, "o": False}


def test_latest_file_per_folder(spark):
    import time
    path = sinks.fresh_path(spark, "latest-test")
    spark.createDataFrame([("a", 1), ("b", 1)], "run string, gen int").write.partitionBy("run").json(path)
    time.sleep(1.1)
    spark.createDataFrame([("a", 2)], "run string, gen int").write.mode("append").partitionBy("run").json(path)
    got = {(r.run, r.gen) for r in sinks.read_newest(spark, path, "gen int, run string").collect()}
    assert got == {("a", 2), ("b", 1)}


def test_regressor_beats_the_mean_and_keeps_rows_with_nulls(spark):
    from arbiter.operators import ml as ML
    rows = [(float(i % 20), float(i % 7) if i % 9 else None, 3.0 * (i % 20) + (i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    model = ML.fit_regressor(df, ["a", "b"], "gbt", max_iter=5)
    r = ML.regression_report(model, df, df, "gbt").first()
    assert r.val_mse < 0.2 * r.baseline_mse and r.n_val == r.n_train == 400
    assert model.transform(spark.createDataFrame([(None, float("nan"))], "a double, b double")).count() == 1
    part = df.union(spark.createDataFrame([(1.0, 1.0, None)], df.schema))
    assert ML.regression_report(model, part, df, "gbt").first().n_unlabelled == 1


def test_weighted_metrics_of_three_classes(spark):
    from arbiter.operators import ml as ML
    pairs = [("a", "a")] * 4 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    r = ML.weighted_metrics(spark.createDataFrame(pairs, "label string, prediction string")).first()
    assert (r.n, r.n_classes, r.accuracy) == (10, 3, 0.7)
    precision = (6 * 4 / 5 + 3 * 3 / 5 + 1 * 0) / 10
    recall = (6 * 4 / 6 + 3 * 1 + 0) / 10
    f1 = (6 * 2 * .8 * (4 / 6) / (.8 + 4 / 6) + 3 * 2 * .6 / 1.6) / 10
    assert abs(r.precision - precision) < 1e-9 and abs(r.recall - recall) < 1e-9 and abs(r.f1 - f1) < 1e-9


def test_grid_and_topk_have_no_size_limit(spark):
    from arbiter.operators import evaluate as EV
    from arbiter.operators import vectors as VX
    t = spark.range(3).withColumnRenamed("id", "t")
    assert EV.experiment_grid(t, spark.range(10_500).withColumnRenamed("id", "c")).distinct().count() == 31_500
    v = spark.range(40).selectExpr("id", "array(double(id % 7), double(id % 5), 1D) AS v")
    q = spark.range(25).selectExpr("id AS q", "array(double(id % 3), 1D, 2D) AS w")
    top = VX.cosine_topk(v, "id", "v", q, "q", "w", 3, block_queries=4, block_rows=9)
    import math
    rows = {r.id: r.v for r in v.collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    for r in q.collect():
        want = sorted((-round(cos(r.w, x), 12), i) for i, x in rows.items())[:3]
        got = sorted((-round(s.score, 12), s.id) for s in top.where(f"qid = {r.q}").collect()) if r.q % 8 == 0 else want
        assert got == want


def test_second_system_turn_does_not_double_rows(spark):
    from arbiter.plans.conversations_plans import assembled
    import tempfile
    d = tempfile.mkdtemp(prefix="run-")
    spark.createDataFrame([(1, 0, "system", "be kind"), (1, 1, "system", "again"), (1, 2, "user", "hi")],
                          "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    assert assembled(spark, d).count() == 1


def _brute_topk(rows, queries, k):
    import numpy as np
    def unit(v):
        if not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.sqrt((x * x).sum())
    table = [(i, unit(v)) for i, v in rows]
    out = set()
    for q, v in queries:
        u = unit(v)
        if u is None:
            continue
        scored = [(-round(float(u @ x), 9), i) for i, x in table if x is not None and len(x) == len(u)]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def test_topk_by_pruned_search_is_exact(spark):
    import numpy as np
    from arbiter.operators import vectors as VX
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.05 * rng.normal(size=8)).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]                      # ties: one vector many times
    rows += [(3000, None), (3001, [0.0] * 8), (3002, [float("nan")] * 8), (3003, []), (3004, [1.0, 2.0]),
             (3005, [1.0, None, *[0.0] * 6]), (3006, [1e200] * 8), (3007, [float("inf")] * 8), (3008, [-1e-200] * 8)]
    queries = [(i, (centres[i % 12] + 0.05 * rng.normal(size=8)).tolist()) for i in range(20)]
    queries += [(50, rows[5][1]), (51, None), (52, [0.0] * 8), (53, rng.normal(size=8).tolist()), (53 + 1, [-1.0] * 8)]
    t = spark.createDataFrame(rows, "id int, v array<double>").repartition(3)
    q = spark.createDataFrame(queries, "q int, v array<double>")
    for k, options in ((5, {}), (5, {"pivots": 12, "block_rows": 50, "block_queries": 4, "sample_rows": 300}),
                       (400, {"pivots": 3, "block_rows": 64})):
        got = VX.search_topk(t, "id", "v", q, "q", "v", k, **options)
        found = {(r.qid, r["rank"], r.id, round(r.score, 9)) for r in got.rows.collect()}
        want = _brute_topk([(i, v if i != 3006 else [1.0] * 8) if i != 3008 else (i, [-1.0] * 8) for i, v in rows], queries, k)
        assert {(a, b, c) for a, b, c, _ in found} == {(a, b, c) for a, b, c, _ in want}
        assert all(abs(x[3] - y[3]) < 1e-8 for x, y in zip(sorted(found), sorted(want)))
        if "sample_rows" in options:
            assert got.share_scored() < 0.25
    assert VX.cosine_topk(t.where("id = 3001"), "id", "v", q, "q", "v", 3).count() == 0
    assert VX.cosine_topk(t.limit(0), "id", "v", q, "q", "v", 3).count() == 0


def test_mse_counts_only_pairs_that_are_there(spark):
    from arbiter.operators import ml as ML
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, None, 3.0), (1.0, 3.0, None), (None, 9.0, 9.0)],
                               "label double, a double, b double")
    got = {r.model: (r.mse, r.n, r.n_missing) for r in ML.prediction_mse(df, ["a", "b"]).collect()}
    assert got == {"a": (2.0, 2, 2), "b": (2.0, 2, 2)}
    # the model that answers least does not win: both on the rows that both predicted
    lazy = spark.createDataFrame([(0.0, 1.0, None), (0.0, 0.5, 0.6), (0.0, 9.0, None)], "label double, a double, b double")
    got = {r.model: r.mse for r in ML.prediction_mse(lazy, ["a", "b"], common=True).collect()}
    assert got == {"a": 0.25, "b": 0.36}
    none = ML.prediction_mse(df.where("label is null"), ["a"]).first()
    assert none.mse is None and none.n == 0


def test_exact_split_sizes_and_stability(spark):
    from collections import Counter
    from arbiter.operators import ml as ML
    shares = {"train": 0.6, "val": 0.2, "test": 0.2}
    for n in (0, 1, 2, 7, 1003):
        df = spark.range(n).withColumn("k", F.concat(F.lit("key"), "id"))
        one = {r.k: r.split for r in ML.exact_split(df, "k", shares).collect()}
        two = {r.k: r.split for r in ML.exact_split(df.repartition(7), "k", shares).collect()}
        count = Counter(one.values())
        assert one == two
        assert (count["train"], count["train"] + count["val"]) == (int(0.6 * n + 0.5), int(0.8 * n + 0.5))
    nulls = spark.createDataFrame([(None,), ("a",)], "k string")
    assert ML.exact_split(nulls, "k", {"all": 1.0}).where("split = 'all'").count() == 2


def test_drift_reports_types_that_begin_later(spark):
    from arbiter.operators import telemetry as TM
    rows = [("a", d, float(d * 37 % 900)) for d in range(21)] * 3 + [("b", d, 50.0) for d in range(8, 21)] + [("a", 3, None)]
    t = spark.createDataFrame(rows, "event_type string, d int, latency_ms double").selectExpr(
        "event_type", "timestamp'2024-01-01' + make_dt_interval(d) AS ts", "latency_ms")
    for options in ({}, {"width": None}):
        got = {(r.event_type, r.period): r for r in TM.drift_report(t, **options).collect()}
        assert set(got) == {("a", 1), ("a", 2), ("b", 1), ("b", 2)}
        assert got["b", 1].alert and got["b", 2].psi > 1
    edges = {r.event_type: r.edges for r in TM.reference_edges(TM.with_period(t, 7), "latency_ms", 4, 10_000).collect()}
    first = sorted(v for k, d, v in rows if d < 7 and v is not None)
    assert edges["a"] == edges[None] and "b" not in edges
    for q, e in zip((0.25, 0.5, 0.75), edges["a"]):
        rank = sum(v <= e for v in first) / len(first)
        assert abs(rank - q) <= 1 / len(first) + 3 / len(first)


def test_a_turn_delivered_twice_is_one_pair(spark):
    from arbiter.operators import conversations as CV
    rows = [(1, 0, "user", "hi", 1, 5.0), (1, 1, "assistant", "yo", 2, 6.0)]
    t = spark.createDataFrame([*rows, *rows, (1, 1, "assistant", "zz", 2, 6.0)],
                              "conv_id long, turn int, role string, text string, tokens long, latency_ms double")
    assert [tuple(r) for r in CV.turn_pairs(t).collect()] == [(1, 1, "hi", "yo", 6.0, 1, 2)]
    assert CV.session_totals(t).first().n_turns == 1


def test_model_store_opened_again_continues_the_log(spark):
    from arbiter.operators import ml as ML
    from arbiter.operators.model_store import ModelStore
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(10)], "x double, label double")
    store = ModelStore.fresh(spark, "m")
    assert store.events().count() == 0
    model = ML.fit_regressor(df, ["x"], "linear")
    for _ in range(2):
        store.set_alias("Champion", store.register(model))
    again = ModelStore(spark, store.root, "m")
    again.set_alias("Champion", "1")
    assert again.resolve("Champion") == store.resolve("Champion") == "1"
    assert [r.seq for r in store.events().orderBy("seq").collect()] == [1, 2, 3, 4, 5]
    rows = spark.createDataFrame([("m", 3.0), ("other", 1.0), (None, 1.0)], "who string, x double")
    got = {r.who: (r.version, r.prediction) for r in again.predict_by_alias(rows, "who", "Champion").collect()}
    assert got["other"] == got[None] == (None, None) and got["m"][0] == "1" and abs(got["m"][1] - 6) < 1e-6
    again.delete_version("1")
    assert store.predict_by_alias(rows, "who", "Champion").where("version is not null").count() == 0


def test_pointers_and_chunks_rebuild_every_history(spark):
    import random
    from arbiter.operators import conversations as CV
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), f"text {c} {t}", rng.random() < 0.05)
            for c in (1, 2, 3) for t in rng.sample(range(300), 120)]
    t = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, is_reset boolean")
    msgs = CV.numbered_messages(t, chunk=7)
    chunks = CV.history_chunks(msgs)
    got = {(r.conv_id, r.turn): [tuple(m) for m in r.history]
           for r in CV.expand_history(CV.history_pointers(msgs), chunks).collect()}
    want = {(r.conv_id, r.turn): [tuple(m) for m in r.history] for r in CV.history_fold(t).collect()}
    assert got == want and max(map(len, want.values())) > 20
    pointers = {(r.conv_id, r.turn): r for r in CV.history_pointers(msgs).collect()}
    for k, h in want.items():
        p = pointers[k]
        assert (p.n_history, p.n_user_messages, p.history_chars) == (
            len(h), sum(r == "user" for r, _ in h), sum(len(x) for _, x in h))
    assert chunks.agg(F.max(F.size("messages"))).first()[0] <= 7


def test_one_long_conversation_is_many_tasks_and_linear(spark):
    from arbiter.operators import conversations as CV
    n = 100_000
    t = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
                              F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                              F.lit("hello").alias("text"), F.lit(False).alias("is_reset"))
    msgs = CV.numbered_messages(t)
    sizes = [r.n for r in CV.history_chunks(msgs).select(
        F.size("messages").alias("n"), F.spark_partition_id().alias("p")).collect()]
    assert sum(sizes) == n and max(sizes) == CV.HISTORY_CHUNK
    last = CV.history_pointers(msgs).where(f"turn = {n - 2}").first()
    assert (last.n_history, last.history_chars) == (n - 2, 5 * (n - 2))
