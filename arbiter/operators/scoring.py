"""Scoring jobs across the Python boundary: replay, injected callables,
SQL-registered pandas UDF, batched embeddings, retry policy.

Every live callable runs in ``mapInPandas`` / pandas UDFs (Arrow batches),
with the client built once per partition.  Live results must be written
before anything reads them twice (``materialize``): Spark may re-run a
Python stage after an executor loss or a re-plan, which would call the
model again and change the replies.
"""

from __future__ import annotations

import hashlib
import queue
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter import defaults as D
from arbiter.session import scratch_path
from arbiter.sources import commits
from arbiter.sources.materialize import checkpointed


def replay(requests: DataFrame, recorded: DataFrame, key) -> DataFrame:
    """Default responder: equi join with recorded replies.  A request without a
    recording is kept and flagged ``missing_response``."""
    j = requests.join(recorded, key, "left")
    reply_cols = [c for c in recorded.columns if c not in ([key] if isinstance(key, str) else key)]
    return j.withColumn("missing_response", F.col(reply_cols[0]).isNull())


def apply_responder(requests: DataFrame, responder_factory: Callable[[], Callable],
                    out_schema: T.StructType) -> DataFrame:
    """Live responder: ``responder_factory()`` builds the client once per
    partition; the returned callable maps a pandas batch to a pandas frame
    with ``out_schema``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = responder_factory()
        for pdf in batches:
            yield fn(pdf)
    return requests.mapInPandas(run, out_schema)


def materialize(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back, cutting the
    lineage so retries never re-invoke a live callable."""
    path = scratch_path(spark, f"materialized/{name}-{int(time.time() * 1000)}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- ledger of replies -----------------------------------------------------------------

def request_key(cols: list[str]) -> Column:
    """Digest of what is asked: equal requests are one request."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


class ReplyLedger:
    """Replies recorded by request key under a folder of the shared storage.

    Requests that the ledger lacks are asked in chunks of about ``chunk_rows``
    and each chunk's replies are made visible by a commit of their own
    (``sources/commits``).  A job that is run again, after it was killed or
    with more requests, asks only what is not recorded; what was in an
    unfinished chunk is asked again and its first replies are never seen.
    Equal requests are asked once and share the reply."""

    def __init__(self, spark: SparkSession, root: str, reply_schema: T.StructType):
        self.spark, self.root, self.reply_schema = spark, root, reply_schema
        self.schema = T.StructType([T.StructField("request_key", T.StringType()), *reply_schema.fields])

    def replies(self) -> DataFrame:
        return commits.read_committed(self.spark, self.root, self.schema)

    def pending(self, keyed: DataFrame) -> DataFrame:
        """Distinct requests (``request_key`` and their columns) without a reply."""
        return keyed.join(self.replies().select("request_key"), "request_key", "left_anti").dropDuplicates(["request_key"])

    def ask(self, requests: DataFrame, cols: list[str], responder_factory: Callable[[], Callable],
            chunk_rows: int = 100_000, max_chunks: int | None = None) -> int:
        """Ask what is missing; returns the number of requests asked.
        ``responder_factory()`` gives a callable from a pandas batch of
        ``cols`` to a frame with the columns of the reply, row by row;
        ``max_chunks`` ends the job early (the rest stays pending)."""
        keyed = requests.select(request_key(cols).alias("request_key"), *cols)
        pending = checkpointed(self.pending(keyed), "pending-requests")
        n = pending.count()
        chunks = max(1, -(-n // chunk_rows))
        chunk = F.pmod(F.xxhash64("request_key"), F.lit(chunks))
        asked = 0
        for i in range(min(chunks, max_chunks or chunks) if n else 0):
            part = pending.where(chunk == i)

            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                respond = responder_factory()
                for pdf in batches:
                    replies = respond(pdf[cols])
                    replies.insert(0, "request_key", pdf["request_key"].to_numpy())
                    yield replies

            commits.commit_write(part.mapInPandas(run, self.schema), self.root)
            asked += part.count()
        return asked

    def answer(self, requests: DataFrame, cols: list[str]) -> DataFrame:
        """``requests`` with the recorded replies; ``missing_response`` marks
        those that have none."""
        keyed = requests.withColumn("request_key", request_key(cols))
        marked = self.replies().withColumn("_found", F.lit(True))
        return keyed.join(marked, "request_key", "left").withColumn(
            "missing_response", F.col("_found").isNull()).drop("_found", "request_key")


def batch_part(cols: list[str], parts: int):
    """Hash part of a row (md5 of its values), as any engine can repeat it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(parts)


def request_payload(df: DataFrame, key: str, cols: list[str], batch_size: int,
                    orient: str = "split", rows_per_part: int = 10_000) -> DataFrame:
    """Scoring requests: batches of ``batch_size`` rows (the last of a hash
    part may be smaller), each one JSON document, either split-oriented
    ``{"dataframe_split": {"columns": [...], "data": [[...], ...]}}`` or
    columnar ``{"inputs": {"col": [...], ...}}`` (rows in key order).

    Rows are numbered inside a hash part, so sparse and repeated keys fill
    their batches; values are written column by column, so types may differ."""
    parts = max(1, -(-df.count() // rows_per_part))
    w = Window.partitionBy("part").orderBy(key, *[c for c in cols if c != key])
    b = (df.withColumn("part", batch_part(cols, parts)).withColumn("_rn", F.row_number().over(w))
         .withColumn("batch_id", F.expr(f"(_rn - 1) div {int(batch_size)}")))

    def piece(c):  # JSON of one value, whatever its type
        one = F.to_json(F.array(F.col(c)))
        return F.substring(one, F.lit(2), F.length(one) - 2)

    names = F.to_json(F.array(*[F.lit(c) for c in cols]))
    listed = lambda v: F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_rn", v.alias("v")))), lambda s: s["v"]), ",")
    if orient == "split":
        row = F.concat(F.lit("["), F.concat_ws(",", *[piece(c) for c in cols]), F.lit("]"))
        body = F.concat(F.lit('{"dataframe_split":{"columns":'), names, F.lit(',"data":['), listed(row), F.lit("]}}"))
    elif orient == "inputs":
        fields = [F.concat(F.to_json(F.array(F.lit(c))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(c)))) - 2),
                           F.lit(":["), listed(piece(c)), F.lit("]")) for c in cols]
        body = F.concat(F.lit('{"inputs":{'), F.concat_ws(",", *fields), F.lit("}}"))
    else:
        raise ValueError(f"unknown orient {orient!r}")
    return b.groupBy("part", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"), body.alias("payload"))


# --- SQL-registered vectorised scorer -----------------------------------------

def word_score(texts: pd.Series) -> pd.Series:
    """Offline default scorer: whitespace word count as a double.  The words
    of one text at a time are held, not those of the batch."""
    return texts.fillna("").map(lambda t: len(t.split())).astype("float64")


def register_score_udf(spark: SparkSession, name: str = "score_model",
                       scorer: Callable[[pd.Series], pd.Series] = word_score) -> None:
    """Register a pandas UDF for SQL: ``SELECT score_model(text) FROM t``."""
    @F.pandas_udf(T.DoubleType())
    def score_model(texts: pd.Series) -> pd.Series:
        return scorer(texts)
    spark.udf.register(name, score_model)


# --- batched embeddings -----------------------------------------------------------

class HashingEmbedder:
    """Deterministic offline embedder: lower-cased word tokens hashed (first 8
    hex digits of md5) into ``dim`` buckets, L2-normalised."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: pd.Series) -> list:
        out = []
        for t in texts.fillna(""):
            v = np.zeros(self.dim, dtype=np.float32)
            for tok in t.lower().split():
                v[int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:8], 16) % self.dim] += 1.0
            n = float(np.linalg.norm(v))
            out.append(v / n if n > 0 else v)
        return out


_EMBEDDERS: dict = {}


def embed_texts(df: DataFrame, text: str = "text", out: str = "embedding",
                dim: int = 64, factory: Callable[[], Callable] | None = None,
                model_key: str | None = None) -> DataFrame:
    """Iterator pandas UDF: embeds Arrow batches.  The model is built once per
    task, or, with a ``model_key`` that names it, once per Python worker (a
    worker keeps the last model only)."""
    make = factory or (lambda: HashingEmbedder(dim))
    named = model_key or (None if factory else f"hashing-{dim}")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _EMBEDDERS.get(named) if named else None
        if model is None:
            model = make()
            _EMBEDDERS.clear()
            if named:
                _EMBEDDERS[named] = model
        for s in batches:
            yield pd.Series([list(map(float, v)) for v in model(s)])
    return df.withColumn(out, embed(F.col(text)))


# --- retry policy -------------------------------------------------------------------

class CallTimeout(Exception):
    """Raised by a callable when a call exceeds its time budget."""


ATTEMPT_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("error", T.StringType()),
])


def call_by_deadline(call: Callable, rec: dict, attempt: int, timeout_s: float):
    """``call(rec, attempt)`` in a thread of its own; :class:`CallTimeout` if
    it has not returned by then.  A call that hangs can't be ended: its thread
    is left behind, and whoever calls on has to bound how many there are."""
    box: queue.SimpleQueue = queue.SimpleQueue()

    def work():
        try:
            box.put((True, call(rec, attempt)))
        except BaseException as e:  # noqa: BLE001 - handed to the caller
            box.put((False, e))

    thread = threading.Thread(target=work, daemon=True)
    thread.start()
    try:
        ok, value = box.get(timeout=timeout_s)
    except queue.Empty:
        raise CallTimeout(f"no reply in {timeout_s:g} s") from None
    if ok:
        return value
    raise value


def retrying_call(requests: DataFrame, call_factory: Callable[[], Callable],
                  attempts: int = D.RETRY_ATTEMPTS, backoff_base: float = D.RETRY_BACKOFF_BASE_S,
                  sleep: Callable[[float], None] | None = None, timeout_s: float | None = D.RETRY_TIMEOUT_S,
                  in_flight: int = 1, max_hung: int = 64) -> DataFrame:
    """One output row per attempt: up to ``attempts`` tries when the call times
    out (waiting backoff_base * 2**attempt between tries); any other error
    ends the request at once.  ``call(row, attempt)`` returns a reply or
    raises; ``sleep`` defaults to no wait for replayed calls.

    A task keeps up to ``in_flight`` requests going, each in a thread with a
    client of its own (``call_factory`` makes it), so waits for replies and
    between tries overlap; rows come back in the order of the requests.  An
    attempt that has no reply after ``timeout_s`` seconds times out, whether
    or not the callable notices, and its client is not used again; None leaves
    time to the callable (a replay can't hang).  Calls that hang for ever hold
    a thread each: with ``max_hung`` of them in a task further attempts fail
    without a call."""
    wait = sleep or (lambda s: None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients, hung = threading.local(), threading.Semaphore(max_hung)

        def attempt_once(rec: dict, a: int) -> None:
            if getattr(clients, "call", None) is None:
                clients.call = call_factory()
            call = clients.call
            if timeout_s is None:
                call(rec, a)
                return
            if not hung.acquire(blocking=False):
                raise RuntimeError(f"{max_hung} calls have not returned")

            def releasing(rec, a):
                try:
                    return call(rec, a)
                finally:
                    hung.release()
            try:
                call_by_deadline(releasing, rec, a, timeout_s)
            except CallTimeout:
                clients.call = None  # the late call may still use it
                raise

        def request(rec: dict) -> list[tuple]:
            rid, rows = int(rec["request_id"]), []
            for a in range(attempts):
                try:
                    attempt_once(rec, a)
                    rows.append((rid, a, "EXECUTED", None))
                    break
                except CallTimeout as e:
                    last = a == attempts - 1
                    rows.append((rid, a, "FAILED" if last else "RETRYING", str(e) or "timeout"))
                    if not last:
                        wait(backoff_base * (2 ** a))
                except Exception as e:  # noqa: BLE001 - any other error ends the request
                    rows.append((rid, a, "FAILED", str(e) or type(e).__name__))
                    break
            return rows

        with ThreadPoolExecutor(in_flight) as pool:
            for pdf in batches:
                records = pdf.to_dict("records")
                done = map(request, records) if in_flight == 1 else pool.map(request, records)
                yield pd.DataFrame([row for rows in done for row in rows], columns=["request_id", "attempt", "state", "error"])
    return requests.mapInPandas(run, ATTEMPT_SCHEMA)


def replayed_outcomes_call():
    """Call replaying recorded attempt outcomes carried on the request row
    (``outcomes``: list of states by attempt)."""
    def call(rec, attempt):
        outcomes = list(rec["outcomes"]) if rec["outcomes"] is not None else []
        state = outcomes[attempt] if attempt < len(outcomes) else "EXECUTED"
        if state == "RETRYING":
            raise CallTimeout("timeout")
        if state == "FAILED":
            raise RuntimeError("error")
        return "ok"
    return call
