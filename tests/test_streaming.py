"""Streaming queries equal their batch twins; late rows are dropped."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from arbiter.sources import fixtures as FX
from arbiter.streaming import metrics as SM
from conftest import SF_SMALL


def test_turn_metrics_stream_equals_batch_twin(spark):
    out = SM.run_available(SM.turn_metrics(SM.telemetry_stream(spark, SF_SMALL)), spark, "t_turns",
                           open_rows=SM.open_turn_metrics)
    t = FX.telemetry(spark, SF_SMALL)
    batch = (t.groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n"))
    a = sorted(tuple(r) for r in out.select("window_start", "event_type", "n").collect())
    b = sorted(tuple(r) for r in batch.collect())
    assert a == b and len(a) > 0


def test_rows_behind_the_watermark_are_dropped(spark):
    d = tempfile.mkdtemp(prefix="arbiter-late-")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    first = [(i, base + dt.timedelta(hours=i), 1, "click", 1.0) for i in range(6)]
    spark.createDataFrame(first, schema).write.parquet(os.path.join(d, "in", "b1"))
    src = spark.readStream.schema(schema).parquet(os.path.join(d, "in", "*"))
    q_df = SM.turn_metrics(FX.telemetry_from(src))
    out, ck = os.path.join(d, "out"), os.path.join(d, "ck")

    def run():
        (q_df.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    run()
    # a row for hour 0 arrives after the watermark passed hour 4: it must not count
    late = [(100, base + dt.timedelta(minutes=5), 1, "click", 1.0),
            (101, base + dt.timedelta(hours=9), 1, "click", 1.0)]
    spark.createDataFrame(late, schema).write.parquet(os.path.join(d, "in", "b2"))
    run()
    rows = {r.window_start: r.n for r in spark.read.parquet(out).collect()}
    assert rows["2024-01-01 00:00:00"] == 1


def test_history_state_across_micro_batches(spark):
    """Turns arriving in two batches give the same history counts as the
    batch fold (state: history list + counters carried between batches)."""
    from arbiter.operators import conversations as CV
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SM.ROCKSDB)
    d = tempfile.mkdtemp(prefix="arbiter-hist-")
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    late = "(conv_id % 2 = 0 AND turn = 1)"   # arrives after the turns that follow it
    conv.where(f"turn < 3 AND NOT {late}").write.parquet(os.path.join(d, "in", "b1"))
    schema = conv.schema
    src = spark.readStream.schema(schema).parquet(os.path.join(d, "in", "*"))
    q_df = SM.history_state(FX.turns_from(src))
    out, ck = os.path.join(d, "out"), os.path.join(d, "ck")

    def run():
        (q_df.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    run()
    conv.where("turn >= 3").write.parquet(os.path.join(d, "in", "b2"))
    run()
    conv.where(f"{late} OR turn = 2").write.parquet(os.path.join(d, "in", "b3"))   # turn 2: delivered again
    run()
    got = {(r.conv_id, r.turn): r.n_history for r in spark.read.parquet(out).collect()}
    exp = {(r.conv_id, r.turn): len(r.history) for r in CV.history_fold(FX.turns(spark, SF_SMALL)).collect()}
    assert got == exp and len(got) > 0


def test_history_state_returns_turns_behind_a_gap(spark):
    """Conversations that lack a turn or start above 0, in two batches."""
    from arbiter.operators import conversations as CV
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SM.ROCKSDB)
    d = tempfile.mkdtemp(prefix="arbiter-gap-")
    schema = "conv_id long, turn long, role string, text string, is_reset boolean"
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {t}", c == 4 and t == 6) for c in range(1, 7) for t in range(12)
            if not (c == 1 and t == 3 or c == 2 and t < 4 or c == 3 and t in (0, 5, 6) or c == 4 and t == 1)]
    turns = spark.createDataFrame(rows, schema)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "*"))
    turns.where("turn >= 8").coalesce(1).write.parquet(os.path.join(d, "b1"))
    turns.where("turn < 8 or turn = 9").coalesce(1).write.parquet(os.path.join(d, "b2"))   # turn 9: delivered again
    got = SM.run_available(SM.history_state(src), spark, "t_gap", open_rows=SM.open_history,
                           state_vars=("waiting", "counters")).collect()
    steps = {(c, t): sum(a == c and b < t and r == "assistant" for a, b, r, *_ in rows) for c, t, *_ in rows}
    want = [(r.conv_id, r.turn, len(r.history), steps[r.conv_id, r.turn]) for r in CV.history_fold(turns).collect()]
    assert sorted(map(tuple, got)) == sorted(want) and len({c for c, *_ in want}) == 6


def _gappy_stream(spark, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SM.ROCKSDB)
    d = tempfile.mkdtemp(prefix=f"arbiter-{name}-")
    schema = "conv_id long, turn long, role string, text string, is_reset boolean"
    rows = [(c, t, "assistant" if t % 2 else "user", "x", False) for c in (1, 2, 3) for t in range(6) if (c, t) not in ((1, 2), (2, 0))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, "in", "b1"))
    return d, spark.readStream.schema(schema).parquet(os.path.join(d, "in", "*")), rows


def _expected(rows):
    want = []
    for c, t, role, *_ in rows:
        before = [r for k, u, r, *_ in rows if k == c and u < t]
        if role == "user":
            want.append((c, t, len(before), before.count("assistant")))
    return sorted(want)


def test_waiting_turns_are_returned_when_a_silent_conversation_expires(spark):
    import time
    d, src, rows = _gappy_stream(spark, "expire")
    out = os.path.join(d, "out")
    q = (SM.history_state(src, ttl="3 seconds").writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(d, "ck")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            time.sleep(1)
            got = sorted(map(tuple, spark.read.schema(SM.HISTORY_OUT).parquet(out).collect())) if os.path.isdir(out) else []
            if len(got) == len(_expected(rows)):
                break
    finally:
        q.stop()
    assert got == _expected(rows)


def test_waiting_turns_are_bounded(spark):
    d, src, rows = _gappy_stream(spark, "bound")
    out = os.path.join(d, "out")
    (SM.history_state(src, max_waiting=2).writeStream.outputMode("append").format("parquet").option("path", out)
     .option("checkpointLocation", os.path.join(d, "ck")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(map(tuple, spark.read.schema(SM.HISTORY_OUT).parquet(out).collect())) == _expected(rows)
