"""Python-boundary connectors: live responder, retries, embeddings, SQL UDF."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.operators import scoring as SC

OUT = T.StructType([T.StructField("resp_id", T.LongType()), T.StructField("reply", T.StringType()),
                    T.StructField("latency_ms", T.DoubleType())])


def test_live_responder_builds_client_once_per_partition(spark):
    req = spark.range(0, 50, numPartitions=4).withColumnRenamed("id", "resp_id").withColumn(
        "message", F.concat(F.lit("q"), F.col("resp_id").cast("string")))

    def factory():
        client = {"calls": 0}

        def respond(pdf: pd.DataFrame) -> pd.DataFrame:
            client["calls"] += 1
            return pd.DataFrame({"resp_id": pdf["resp_id"], "reply": pdf["message"].str.upper(),
                                 "latency_ms": 1.0})
        return respond
    out = SC.apply_responder(req, factory, OUT)
    rows = {r.resp_id: r.reply for r in out.collect()}
    assert len(rows) == 50 and rows[7] == "Q7"


def test_replay_flags_missing(spark):
    req = spark.createDataFrame([(1,), (2,)], "resp_id long")
    rec = spark.createDataFrame([(1, "hi")], "resp_id long, reply string")
    got = {r.resp_id: (r.reply, r.missing_response) for r in SC.replay(req, rec, "resp_id").collect()}
    assert got == {1: ("hi", False), 2: (None, True)}


def test_retry_policy_backoff_and_errors(spark):
    req = spark.createDataFrame([(1, ["RETRYING", "RETRYING", "EXECUTED"]),
                                 (2, ["RETRYING", "RETRYING", "RETRYING"]),
                                 (3, ["FAILED", "EXECUTED", "EXECUTED"]),
                                 (4, ["EXECUTED"])], "request_id long, outcomes array<string>")
    rows = sorted(tuple(r) for r in SC.retrying_call(req, SC.replayed_outcomes_call).collect())
    assert rows == [(1, 0, "RETRYING", "timeout"), (1, 1, "RETRYING", "timeout"), (1, 2, "EXECUTED", None),
                    (2, 0, "RETRYING", "timeout"), (2, 1, "RETRYING", "timeout"), (2, 2, "FAILED", "timeout"),
                    (3, 0, "FAILED", "error"), (4, 0, "EXECUTED", None)]


def test_backoff_schedule():
    waits = []

    class FakeDF:
        def mapInPandas(self, fn, schema):
            return list(fn(iter([pd.DataFrame({"request_id": [9], "outcomes": [["RETRYING"] * 3]})])))
    SC.retrying_call(FakeDF(), SC.replayed_outcomes_call, sleep=waits.append)
    assert waits == [2.0, 4.0]


def test_embeddings_deterministic_unit_norm(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "")], "id long, text string")
    rows = {r.id: r.embedding for r in SC.embed_texts(df).collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 64
    assert abs(sum(x * x for x in rows[1]) - 1.0) < 1e-5 and sum(rows[3]) == 0


def test_materialize_and_sql_udf(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "x")], "id long, text string")
    m = SC.materialize(df, spark, "t")
    assert sorted(m.collect()) == sorted(df.collect())
    ckpt = spark.conf.get("spark.checkpoint.dir")
    norm = lambda p: p.replace("file://", "").replace("file:", "")
    assert norm(m.inputFiles()[0]).startswith(norm(ckpt))
    SC.register_score_udf(spark, "score_model_t")
    m.createOrReplaceTempView("t_udf")
    assert {r.id: r.s for r in spark.sql("SELECT id, score_model_t(text) AS s FROM t_udf").collect()} == {1: 2.0, 2: 1.0}


def test_request_payload_orientations(spark):
    import json
    df = spark.createDataFrame([(i * 1000, i * 10) for i in range(5)], "id long, v long")
    split = {r.batch_id: json.loads(r.payload) for r in SC.request_payload(df, "id", ["id", "v"], 2).collect()}
    assert split[0] == {"dataframe_split": {"columns": ["id", "v"], "data": [[0, 0], [1000, 10]]}}
    cols = {r.batch_id: json.loads(r.payload) for r in
            SC.request_payload(df, "id", ["id", "v"], 2, orient="inputs").collect()}
    assert cols[2] == {"inputs": {"id": [4000], "v": [40]}}
    mixed = spark.createDataFrame([(7, 'a"b', 1.5, None)] * 5, "id long, s string, x double, n int")
    docs = [json.loads(r.payload) for r in SC.request_payload(mixed, "id", ["id", "s", "x", "n"], 2).collect()]
    assert sorted(len(p["dataframe_split"]["data"]) for p in docs) == [1, 2, 2]
    assert docs[0]["dataframe_split"]["data"][0] == [7, 'a"b', 1.5, None]


def test_a_call_that_hangs_ends_at_the_limit_and_waits_overlap(spark):
    import time

    def factory():
        import time

        def call(rec, attempt):
            if rec["request_id"] == 3:
                time.sleep(60)
            time.sleep(0.5)
            return "ok"
        return call

    req = spark.range(0, 8, numPartitions=1).withColumnRenamed("id", "request_id")
    start = time.time()
    rows = sorted(tuple(r) for r in SC.retrying_call(req, factory, attempts=2, timeout_s=1.5, in_flight=8).collect())
    took = time.time() - start
    assert [r for r in rows if r[0] == 3] == [(3, 0, "RETRYING", "no reply in 1.5 s"), (3, 1, "FAILED", "no reply in 1.5 s")]
    assert [r for r in rows if r[0] != 3] == [(i, 0, "EXECUTED", None) for i in (0, 1, 2, 4, 5, 6, 7)]
    assert 3.0 <= took < 3.0 + 0.5 * 7  # not one after the other: that alone would be 3.5 s more


def test_hung_calls_are_bounded_and_their_clients_are_not_reused():
    import threading
    clients, stop = [], threading.Event()

    def factory():
        seen = []
        clients.append(seen)

        def call(rec, attempt):
            seen.append(rec["request_id"])
            if rec["request_id"] < 2:
                stop.wait(20)
            return "ok"
        return call

    class FakeDF:
        def mapInPandas(self, fn, schema):
            return list(fn(iter([pd.DataFrame({"request_id": [0, 1, 2, 3]})])))
    [out] = SC.retrying_call(FakeDF(), factory, attempts=1, timeout_s=0.2, max_hung=2)
    stop.set()
    assert out.state.tolist() == ["FAILED"] * 4 and "no reply" in out.error[0]
    assert out.error[2] == out.error[3] == "2 calls have not returned"
    assert clients[:2] == [[0], [1]]


def test_ledger_asks_only_what_is_not_recorded(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()
    folder = str(log)

    def factory():
        def answer(batch):
            import os
            import uuid
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write("\n".join(map(str, batch["q"])) + "\n")
            if os.path.exists(os.path.join(folder, "die")) and (batch["q"] == 13).any():
                raise RuntimeError("killed")
            return pd.DataFrame({"reply": [f"r{q}" if q == q else None for q in batch["q"]]})
        return answer

    def asked():
        return sorted(line for f in log.iterdir() if f.name != "die" for line in f.read_text().split())

    ledger = SC.ReplyLedger(spark, str(tmp_path / "ledger"), T.StructType().add("reply", "string"))
    req = spark.createDataFrame([(i, i % 40) for i in range(50)], "id long, q long")
    assert ledger.ask(req, ["q"], factory, chunk_rows=10, max_chunks=2) < 40
    half = asked()
    assert len(half) == len(set(half)) == ledger.replies().count()
    ledger.ask(req, ["q"], factory, chunk_rows=10)
    assert asked() == sorted(map(str, range(40))) and ledger.pending(req.select(
        SC.request_key(["q"]).alias("request_key"), "q")).count() == 0
    # a job that dies leaves what it had committed; more requests ask only the new ones
    (log / "die").touch()
    more = spark.createDataFrame([(i, i) for i in range(100, 130)] + [(1, 13_000), (2, None)], "id long, q long")
    ledger.ask(more, ["q"], factory, chunk_rows=8, max_chunks=1)
    kept = ledger.replies().count()
    ledger.ask(more, ["q"], factory, chunk_rows=8)
    assert ledger.replies().count() == 40 + 32 > kept
    got = {r.id: r.reply for r in ledger.answer(req, ["q"]).collect()}
    assert got == {i: f"r{i % 40}" for i in range(50)}
    lost = ledger.answer(spark.createDataFrame([(1, 777)], "id long, q long"), ["q"]).first()
    assert lost.missing_response and lost.reply is None


def test_a_scorer_holds_the_words_of_one_text(spark):
    import tracemalloc

    import pandas as pd

    from arbiter.operators.scoring import word_score
    texts = pd.Series([f"a{i} " * 2000 for i in range(300)] + [None, "", " \t", "one\u00a0two  three"])
    tracemalloc.start()
    got = word_score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.dtype == "float64" and list(got) == [2000.0] * 300 + [0.0, 0.0, 0.0, 3.0]
    assert peak < 5 << 20
