"""Python-boundary queries: SQL pandas UDF, batched embeddings, retries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from arbiter.operators import scoring as SC
from arbiter.plans.catalog import query
from arbiter.plans.oracle_views import with_views
from arbiter.session import override_conf
from arbiter.sources import fixtures as FX
from arbiter.sources.tables import read_table


@query("score_udf_sql", """
    SELECT doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE) AS score FROM documents""")
def q_score_udf_sql(spark, sf_dir):
    # a worker holds a few batches of whole texts
    override_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
                          "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)})
    SC.register_score_udf(spark, "score_model")
    view = f"arbiter_documents_{uuid.uuid4().hex[:8]}"
    read_table(spark, sf_dir, "documents", ["doc_id", "text"]).createOrReplaceTempView(view)
    return spark.sql(f"SELECT doc_id, score_model(text) AS score FROM {view}")


@query("embed_texts", """
    WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\S+')) AS tok FROM documents),
    counts AS (SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 64 AS bucket, count(*) AS n
               FROM tokens GROUP BY ALL)
    SELECT doc_id, 64 AS dim, 1.0::DOUBLE AS norm, CAST(arg_min(bucket, (-n, bucket)) AS BIGINT) AS top_bucket
    FROM counts GROUP BY doc_id""")
def q_embed_texts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    e = SC.embed_texts(d, "text", "embedding", dim=64)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return e.select("doc_id", F.size("embedding").alias("dim"), F.round(norm, 5).alias("norm"),
                    (F.array_position("embedding", F.array_max("embedding")) - 1).alias("top_bucket"))


@query("retrying_call", with_views("""
    , o AS (SELECT request_id, list(state ORDER BY attempt) AS outcomes FROM telemetry GROUP BY request_id),
    a AS (SELECT o.request_id, CAST(g.range AS BIGINT) AS attempt,
                 coalesce(o.outcomes[CAST(g.range AS INTEGER) + 1], 'EXECUTED') AS rec
          FROM o, range(0, 3) g),
    s AS (SELECT request_id, coalesce(min(CASE WHEN rec <> 'RETRYING' THEN attempt END), 2) AS stop
          FROM a GROUP BY request_id)
    SELECT a.request_id, a.attempt,
           CASE WHEN rec = 'EXECUTED' THEN 'EXECUTED' WHEN rec = 'FAILED' THEN 'FAILED'
                WHEN a.attempt = 2 THEN 'FAILED' ELSE 'RETRYING' END AS state,
           CASE WHEN rec = 'FAILED' THEN 'error' WHEN rec = 'RETRYING' THEN 'timeout' END AS error
    FROM a JOIN s ON s.request_id = a.request_id WHERE a.attempt <= s.stop""", "telemetry"))
def q_retrying_call(spark, sf_dir):
    # recorded attempt outcomes are replayed through the retry policy; a group
    # is one request (at most three attempts), never a hot key
    t = FX.telemetry(spark, sf_dir)
    req = t.groupBy("request_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("attempt", "state"))), lambda s: s["state"])
        .alias("outcomes"))
    return SC.retrying_call(req, SC.replayed_outcomes_call, timeout_s=None)  # a replay can't hang


def _answered(spark, sf_dir):
    """A ledger whose first job was ended after one of its chunks and whose
    second job asked the rest; (ledger, requests, asked by each)."""
    from pyspark.sql import types as T

    from arbiter.sources.sinks import fresh_path
    req = FX.responses(spark, sf_dir).select("resp_id", F.col("response").alias("prompt"))

    def responder():
        import hashlib

        import pandas as pd

        def answer(batch):
            return pd.DataFrame({"reply": [f"reply {len(p)} {hashlib.md5(p.encode()).hexdigest()}" for p in batch["prompt"]]})
        return answer

    ledger = SC.ReplyLedger(spark, fresh_path(spark, "ledger"), T.StructType().add("reply", "string"))
    half = -(-req.count() // 2)
    first = ledger.ask(req, ["prompt"], responder, chunk_rows=half, max_chunks=1)
    second = ledger.ask(req, ["prompt"], responder, chunk_rows=half)
    return ledger, req, (first, second)


@query("live_generate", """
    SELECT doc_id AS resp_id, 'reply ' || length(text) || ' ' || md5(text) AS reply FROM documents""")
def q_live_generate(spark, sf_dir):
    # a live responder (here a deterministic one): a resumed job asks only what
    # the ledger lacks, and a retried reader never asks again
    ledger, req, _ = _answered(spark, sf_dir)
    return ledger.answer(req, ["prompt"]).select("resp_id", "reply")


@query("reply_ledger", """
    SELECT 'reply ' || length(text) || ' ' || md5(text) AS reply, CAST(1 AS BIGINT) AS n_recorded,
           CAST(count(*) AS BIGINT) AS n_requests, (SELECT CAST(count(DISTINCT text) AS BIGINT) FROM documents) AS n_asked
    FROM documents GROUP BY text""")
def q_reply_ledger(spark, sf_dir):
    # equal prompts are asked once; both jobs together asked every prompt once
    ledger, req, asked = _answered(spark, sf_dir)
    recorded = ledger.replies().groupBy("reply").agg(F.count(F.lit(1)).alias("n_recorded"))
    used = ledger.answer(req, ["prompt"]).groupBy("reply").agg(F.count(F.lit(1)).alias("n_requests"))
    return recorded.join(used, "reply").withColumn("n_asked", F.lit(sum(asked)).cast("bigint"))
