"""Structured Streaming over telemetry and conversation turns.

Sources are file streams over the table folders; state is bounded by a
watermark (windows, sessions, deduplication) or a time to live (history), and
queries run to a parquet sink with their
checkpoint in the shared checkpoint folder (restartable after executor or
driver loss).  ``run_available`` processes what is there now
(``trigger(availableNow=True)``) and returns the sink as a batch DataFrame.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter import defaults as D
from arbiter.operators import windows as W
from arbiter.sources import fixtures as FX
from arbiter.sources.sinks import fresh_path
from arbiter.sources.tables import table_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over one table.  The single-file tables are addressed by a
    glob, which the file source lists like a folder of arriving files."""
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path[:-1] + "[" + path[-1] + "]")


def telemetry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stream_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return FX.telemetry_from(e)


def run_available(df: DataFrame, spark: SparkSession, name: str, mode: str = "append",
                  foreach_batch: Callable | None = None,
                  open_rows: Callable[..., DataFrame] | None = None,
                  state_vars: tuple[str, ...] = ()) -> DataFrame:
    """Run the stream over all currently available input, then read the sink.

    In append mode a window reaches the sink once the watermark has passed
    it.  ``open_rows`` turns the state that is left in the checkpoint (the
    windows still open) into rows of the sink; a window is in one of the two,
    since it leaves the state when it is emitted.  A query with custom state
    names the ``state_vars`` that ``open_rows`` takes, one table each."""
    out, ckpt = fresh_path(spark, f"stream/{name}/out"), fresh_path(spark, f"stream/{name}/ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(lambda batch, epoch: foreach_batch(batch, epoch, out))
    else:
        w = w.format("parquet").option("path", out)
    w.start().awaitTermination()
    return with_open(spark, out, ckpt, open_rows, state_vars)


def with_open(spark: SparkSession, out: str, ckpt: str,
              open_rows: Callable[..., DataFrame] | None = None,
              state_vars: tuple[str, ...] = ()) -> DataFrame:
    closed = spark.read.parquet(out)
    if open_rows is None:
        return closed
    read = lambda: spark.read.format("statestore")
    states = [read().option("stateVarName", v).load(ckpt) for v in state_vars] or [read().load(ckpt)]
    return closed.unionByName(open_rows(*states))


def _tenths_sum(c: str):
    return F.sum(F.round(F.col(c) * F.lit(10.0)).cast("bigint"))


def _turn_rows(g: DataFrame) -> DataFrame:
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "event_type", "n",
                    (F.col("lat10").cast("double") / (F.col("n") * F.lit(10)).cast("double"))
                    .alias("avg_latency_ms"), "max_latency_ms")


def turn_metrics(t: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Per event-time window and event type: count, mean and max latency."""
    g = (t.withWatermark("ts", delay)
         .groupBy(F.window("ts", window).alias("w"), "event_type")
         .agg(F.count(F.lit(1)).alias("n"), _tenths_sum("latency_ms").alias("lat10"),
              F.max("latency_ms").alias("max_latency_ms")))
    return _turn_rows(g)


def open_turn_metrics(state: DataFrame) -> DataFrame:
    """Rows of :func:`turn_metrics` for the windows still in state."""
    return _turn_rows(state.select(
        F.col("key.window").alias("w"), "key.event_type", F.col("value.count").alias("n"),
        F.col("value.sum").alias("lat10"), F.col("value.max").alias("max_latency_ms")))


def _outcome_rows(g: DataFrame) -> DataFrame:
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "state", "n")


def attempt_outcomes(t: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Attempts deduplicated on (request_id, attempt) within the watermark
    (a retried delivery is counted once), counted per window and state."""
    d = (t.withWatermark("ts", delay)
         .dropDuplicatesWithinWatermark(["request_id", "attempt"]))
    return _outcome_rows(d.groupBy(F.window("ts", window).alias("w"), "state").agg(F.count(F.lit(1)).alias("n")))


def open_attempt_outcomes(state: DataFrame) -> DataFrame:
    """Rows of :func:`attempt_outcomes` for the windows still in state."""
    return _outcome_rows(state.select(F.col("key.window").alias("w"), "key.state", F.col("value.count").alias("n")))


def _session_rows(g: DataFrame) -> DataFrame:
    return g.select("user_id",
                    F.date_format("s.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"),
                    F.date_format("s.end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_end"),
                    "n_events", (F.col("lat10").cast("double") / F.lit(10.0)).alias("total_latency_ms"))


def session_totals(t: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Per user session (gap-separated): events and total latency."""
    g = (t.withWatermark("ts", delay)
         .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
         .agg(F.count(F.lit(1)).alias("n_events"), _tenths_sum("latency_ms").alias("lat10")))
    return _session_rows(g)


def open_session_totals(state: DataFrame) -> DataFrame:
    """Rows of :func:`session_totals` for the sessions still in state."""
    return _session_rows(state.select(
        "key.user_id", F.col("value.session_window").alias("s"), F.col("value.count").alias("n_events"),
        F.col("value.sum").alias("lat10")))


# --- custom state: conversation history with resets -------------------------------

HISTORY_OUT = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("n_history", T.LongType()),
    T.StructField("step", T.LongType()),
])


COUNTERS = T.StructType([T.StructField("next_turn", T.LongType()), T.StructField("steps", T.LongType()),
                         T.StructField("n_history", T.LongType()), T.StructField("n_waiting", T.LongType())])
WAITING = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                        T.StructField("is_reset", T.BooleanType())])


def _history_processor(ttl_ms: int | None, max_waiting: int):
    from pyspark.sql.streaming import StatefulProcessor

    class HistoryProcessor(StatefulProcessor):
        """Keyed by conversation.  Value state: the next turn to fold, the
        assistant steps, the history length so far and how many turns wait.
        List state: turns that came before an earlier one (their number and
        role only, no text); they are folded when the gap has closed, so
        counters do not depend on the order of arrival.

        No turn is lost: a conversation that has been silent for ``ttl_ms``
        has its waiting turns folded in their order, over the gap, and
        returned before its state goes; so are they once more than
        ``max_waiting`` wait."""

        def init(self, handle):
            self.handle = handle
            self.counters = handle.getValueState("counters", COUNTERS)
            self.waiting = handle.getListState("waiting", WAITING)

        def _load(self) -> tuple[int, int, int, int]:
            return tuple(self.counters.get()) if self.counters.exists() else (0, 0, 0, 0)

        def _early(self) -> dict:
            return {int(t): (role, reset) for t, role, reset in self.waiting.get()} if self.waiting.exists() else {}

        @staticmethod
        def _fold(conv, state, early: dict, over_gaps: bool) -> tuple[tuple, list[tuple]]:
            """Fold from the next turn on (``over_gaps``: everything that
            waits); what is folded leaves ``early``."""
            turn, steps, n_hist, _ = state
            out: list[tuple] = []
            while early:
                if turn not in early:
                    if not over_gaps:
                        break
                    turn = min(early)
                role, reset = early.pop(turn)
                if reset:
                    n_hist = 0
                else:
                    if role == "user":
                        out.append((conv, turn, n_hist, steps))
                    n_hist += role in ("user", "assistant")
                    steps += role == "assistant"
                turn += 1
            return (turn, steps, n_hist, len(early)), out

        def _expire_later(self, timers) -> None:
            if ttl_ms is not None:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + ttl_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            turn, steps, n_hist, n_waiting = self._load()
            fresh = {}
            for chunk in rows:
                for t, role, reset in zip(chunk["turn"], chunk["role"], chunk["is_reset"]):
                    if t >= turn:  # an earlier one was folded already: a repeated delivery
                        fresh[int(t)] = (role, bool(reset))
            self._expire_later(timerValues)
            n_waiting += len(fresh)
            if turn not in fresh and n_waiting <= max_waiting:  # nothing to fold: the list is added to, not rewritten
                if fresh:
                    self.waiting.appendList([(t, *fresh[t]) for t in sorted(fresh)])
                self.counters.update((turn, steps, n_hist, n_waiting))
                yield _history_rows([])
                return
            early = self._early() | fresh
            state, out = self._fold(int(key[0]), (turn, steps, n_hist, 0), early, over_gaps=len(early) > max_waiting)
            self.counters.update(state)
            if early:
                self.waiting.put([(t, *early[t]) for t in sorted(early)])
            else:
                self.waiting.clear()
            yield _history_rows(out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            _, out = self._fold(int(key[0]), self._load(), self._early(), over_gaps=True)
            self.counters.clear()
            self.waiting.clear()
            yield _history_rows(out)

        def close(self):
            pass

    return HistoryProcessor()


def _history_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "turn", "n_history", "step"])


def history_state(turns: DataFrame, ttl: str | None = None, max_waiting: int = 100_000) -> DataFrame:
    """History length and step of every user turn; turns are numbered from 0.
    A turn behind a gap waits for the missing one: what still waits when the
    available input has ended comes from :func:`open_history`.  The text never
    enters the state: four numbers a conversation, and the turns that wait
    for an earlier one, ``max_waiting`` at most.  Beyond that, and when a
    conversation has been silent for ``ttl``, the gap is given up: what waits
    is folded in its order and returned, and a turn that comes for the gap
    later is taken for a repeated delivery.

    Turns carry no event time, so expiry goes by processing time: give a
    ``ttl`` ("7 days") to a stream that runs on, whose conversations end.  A
    run over the available input must not have one (in that mode Spark never
    runs out of batches)."""
    ttl_ms = int(pd.Timedelta(ttl).total_seconds() * 1000) if ttl else None
    return (turns.select("conv_id", "turn", "role", F.coalesce("is_reset", F.lit(False)).alias("is_reset"))
            .groupBy("conv_id")
            .transformWithStateInPandas(statefulProcessor=_history_processor(ttl_ms, max_waiting),
                                        outputStructType=HISTORY_OUT, outputMode="Append",
                                        timeMode="ProcessingTime" if ttl else "None"))


def open_history(waiting: DataFrame, counters: DataFrame) -> DataFrame:
    """Rows of :func:`history_state` for the turns that still wait in state (a
    turn before them is missing), folded in turn order on from the counters."""
    reset = F.col("t.is_reset").cast("bigint")
    one = lambda *roles: F.coalesce(F.col("t.role").isin(*roles).cast("bigint"), F.lit(0)) * (1 - reset)
    turns = (waiting.select("key.conv_id", F.col("list_element").alias("t"))
             .select("conv_id", "t.turn", "t.role", reset.alias("reset"), one("user", "assistant").alias("message"),
                     one("assistant").alias("reply"))
             .dropDuplicates(["conv_id", "turn"]))
    width = W.range_width(turns, "turn")
    x = W.running_sum(turns, ["conv_id"], "turn", "reset", "segment", width)
    x = W.running_sum(x, ["conv_id"], "turn", "reply", "replies", width)
    x = W.running_sum(x, ["conv_id", "segment"], "turn", "message", "messages", width)
    before = counters.select("key.conv_id", "value.steps", F.col("value.n_history").alias("held"))
    return (x.where((F.col("role") == "user") & (F.col("reset") == 0)).join(before, "conv_id")
            .select("conv_id", "turn",
                    (F.col("messages") - 1 + F.when(F.col("segment") == 0, F.col("held")).otherwise(0)).alias("n_history"),
                    (F.col("steps") + F.col("replies")).alias("step")))


# --- gate check per micro-batch -------------------------------------------------------

def gate_alert_writer(latency_max: float = D.GATE_AVG_LATENCY_MS, error_max: float = 0.25):
    """foreachBatch body: summarise the micro-batch, check gates, append the
    verdict rows (idempotent per batch id: written under batch_id=<id>)."""
    def write(batch: DataFrame, epoch: int, out: str) -> None:
        s = batch.agg(F.count(F.lit(1)).alias("n"),
                      (_tenths_sum("latency_ms").cast("double") /
                       (F.count("latency_ms") * F.lit(10)).cast("double")).alias("avg_latency_ms"),
                      F.avg((F.col("state") == "FAILED").cast("double")).alias("error_rate"))
        rows = s.select(F.explode(F.array(
            F.struct(F.lit("avg_latency_ms").alias("gate"), F.col("avg_latency_ms").alias("actual"),
                     F.lit(float(latency_max)).alias("threshold"),
                     (F.col("avg_latency_ms") <= F.lit(float(latency_max))).alias("passed")),
            F.struct(F.lit("error_rate").alias("gate"), F.col("error_rate").alias("actual"),
                     F.lit(float(error_max)).alias("threshold"),
                     (F.col("error_rate") <= F.lit(float(error_max))).alias("passed")))).alias("g"),
            F.col("n").alias("n_rows"))
        flat = rows.select("g.gate", "g.actual", "g.threshold", "g.passed", "n_rows")
        flat.write.mode("overwrite").parquet(f"{out}/batch_id={epoch}")
    return write
