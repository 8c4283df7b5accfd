"""Engine inputs derived from the driver tables (FIXTURES.md F1-F12).

Large inputs (responses, judge text, telemetry, registry events, turns, tool
calls, tabular rows, vectors) are projections of the driver tables, so their
size grows with the scale factor.  Config inputs (cases, probes, prompts,
gates) are small literal tables built on the driver, broadcast by the jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter import schemas as S
from arbiter.functions.text import approx_tokens, word_count
from arbiter.sources.local import local_table
from arbiter.sources.tables import read_events, read_table

# --- fixed values: golden cases of the test corpus (F2) ------------------------
GOLDEN_CASES = [
    ("case-0", "Question for case 0", ["the", "tion", "ing"], ["und"], 160),
    ("case-1", "Question for case 1", ["that", "with", "and", "est"], [], 160),
    ("case-2", "Question for case 2", ["elle", "des", "ment"], ["the"], 160),
    ("case-3", "Question for case 3", ["que", "para", "con", "ción"], ["sch"], 160),
    ("case-4", "Question for case 4", ["the", "and", "est", "wh", "tion"], ["elle", "que"], 120),
]
CORPUS_CTA = "thre"                   # call-to-action parameter for this corpus
N_CASES = 5

# --- fixed values: smoke probes of the test corpus (F7) ---------------------------
SMOKE_PROBES = [
    ("smoke-0", "Probe 0", ["the", "tion"], [], 8000.0),
    ("smoke-1", "Probe 1", ["est"], ["sch"], 8000.0),
    ("smoke-2", "Probe 2", [], ["elle"], None),
]

# --- few-shot messages of the turn fixture (F6) -----------------------------------
FEW_SHOTS = [("user", "Which form do I need for a refund?"),
             ("assistant", "Fill in the return form on the orders page.")]

# --- registered prompt templates (F11) ---------------------------------------------
PROMPTS = [
    ("assistant_prompt", 1, "Reply briefly and politely. The customer asks: {{question}}", "production"),
    ("resume_prompt", 1,
     "Read the page text between the bars | {{clean_resume_text}} | and list every ability it names, "
     "as one object such as { 'skills': [] }", "production"),
]


def golden_cases(spark: SparkSession) -> DataFrame:
    return local_table(spark, GOLDEN_CASES, S.GOLDEN_CASE)


def smoke_probes(spark: SparkSession) -> DataFrame:
    return local_table(spark, SMOKE_PROBES, S.SMOKE_PROBE)


def prompts(spark: SparkSession) -> DataFrame:
    return local_table(spark, PROMPTS, S.PROMPT)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recorded responses, one per document; template = source."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    ord_ = F.substring(F.col("source"), 4, 16).cast("int")
    return d.select(
        F.col("doc_id").alias("resp_id"),
        F.col("source").alias("template"),
        ord_.alias("ord"),
        F.concat(F.lit("case-"), F.expr(f"(doc_id div 20) % {N_CASES}").cast("string")).alias("case_id"),
        F.col("text").alias("response"),
        (((F.col("doc_id") * 7919) % 90010) / F.lit(10.0)).alias("latency_ms"),
        (F.lit(40) + F.lit(10) * ord_).cast("bigint").alias("input_tokens"),
        approx_tokens(word_count("text")).alias("output_tokens"),
    )


def judge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw judge replies (bare, fenced, fenced-json, malformed, followed by
    other text); NULL for the templates that were not judged."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    ord_ = F.substring(F.col("source"), 4, 16).cast("int")
    j = d.withColumn("judged", ord_ % 4 != 0).join(lab, "doc_id", "left")
    q = F.coalesce(F.col("quality").cast("bigint"), F.col("doc_id") % 2)
    t = F.coalesce(F.col("toxic").cast("bigint"), F.lit(0).cast("bigint"))
    body = F.format_string(
        '{"helpfulness": %d, "faithfulness": %d, "conciseness": %d, "safety": %d, "reasoning": "r%d"}',
        F.lit(1) + F.lit(4) * q, F.lit(5) - F.col("doc_id") % 3, F.lit(1) + F.col("doc_id") % 5,
        F.lit(5) - F.lit(4) * t, F.col("doc_id"))
    wrapped = (F.when(F.col("doc_id") % 97 == 0, F.lit("not json"))
               .when(F.col("doc_id") % 89 == 0, F.concat(body, F.lit(" Hope this helps!")))
               .when(F.col("doc_id") % 3 == 0, body)
               .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
               .otherwise(F.concat(F.lit("```\n"), body, F.lit("\n```"))))
    return j.select(F.col("doc_id").alias("resp_id"), F.col("source").alias("template"),
                    F.concat(F.lit("case-"), F.expr(f"(doc_id div 20) % {N_CASES}").cast("string")).alias("case_id"),
                    F.when(F.col("judged"), wrapped).alias("judge_raw"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request attempts with state and latency, keyed by user session."""
    e = read_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "value"])
    return telemetry_from(e)


def telemetry_from(e: DataFrame) -> DataFrame:
    """F4 projection of an events frame (batch or streaming)."""
    state = (F.when(F.col("event_type") == "error", "FAILED")
             .when(F.col("event_type") == "view", "RETRYING").otherwise("EXECUTED"))
    return e.select(
        "event_id", "ts", "user_id", "event_type",
        F.expr("event_id div 3").alias("request_id"),
        (F.col("event_id") % 3).alias("attempt"),
        state.alias("state"),
        F.round(F.col("value") * 40, 1).alias("latency_ms"),
    )


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 registry log, materialised once per events snapshot (it is an
    append-only table in the model; every lifecycle query scans it)."""
    from arbiter.sources.materialize import materialized
    from arbiter.sources.tables import table_path
    return materialized(spark, "registry_events", [table_path(sf_dir, "events")],
                        lambda: derive_registry_events(spark, sf_dir))


def registry_state(spark: SparkSession, sf_dir: str):
    """State of the registry log: a snapshot of its first half, refreshed
    with the rest; built once per events snapshot."""
    from arbiter.sources import registry_snapshot as RS
    from arbiter.sources.materialize import materialized_path
    from arbiter.sources.tables import table_path
    events = registry_events(spark, sf_dir)

    def build(path: str) -> None:
        half = events.agg(F.expr("max(seq) div 2")).first()[0]
        if half is not None:
            RS.refresh(spark, path, events.where(F.col("seq") <= half))
        RS.refresh(spark, path, events)

    path = materialized_path(spark, "registry_state", [table_path(sf_dir, "events")], build)
    found = RS.newest(spark, path)
    from arbiter.operators.registry import fold_log
    return found[0] if found else fold_log(events)


def derive_registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """append-only registry log derived from events.

    signup -> register; view -> alias candidate; purchase -> alias production
    + tag cd_production=deployed; click -> alias champion (k even) or tag
    cd_staging pass/fail; error -> delete alias candidate (k < 50), the model
    (k = 99) or version 1 + k % 5.  Writes target the newest version registered so far.
    """
    from arbiter.operators.registry import SEQ_RANGE
    from arbiter.operators.windows import running_sum
    e = read_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"])
    e = e.select(
        F.col("user_id").cast("string").alias("model"),
        F.col("event_id").alias("seq"), "ts", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("event_type") == "signup").cast("bigint").alias("_is_reg"))
    e = running_sum(e, ["model"], "seq", "_is_reg", "_n_reg", SEQ_RANGE)
    e = e.where(F.col("_n_reg") > 0)
    newest = F.col("_n_reg").cast("string")
    ev = F.struct

    def mk(kind, version=None, alias=None, key=None, value=None):
        return ev(F.lit(kind).alias("kind"),
                  (version if version is not None else F.lit(None).cast("string")).alias("version"),
                  (F.lit(alias) if alias is not None else F.lit(None).cast("string")).alias("alias"),
                  (F.lit(key) if key is not None else F.lit(None).cast("string")).alias("tag_key"),
                  (value if value is not None else F.lit(None).cast("string")).alias("tag_value"))

    k = F.col("k")
    items = (F.when(F.col("event_type") == "signup", F.array(mk("register", newest)))
             .when(F.col("event_type") == "view", F.array(mk("set_alias", newest, "candidate")))
             .when(F.col("event_type") == "purchase",
                   F.array(mk("set_alias", newest, "production"),
                           mk("set_tag", newest, key="cd_production", value=F.lit("deployed"))))
             .when((F.col("event_type") == "click") & (k % 2 == 0),
                   F.array(mk("set_alias", newest, "champion")))
             .when(F.col("event_type") == "click",
                   F.array(mk("set_tag", newest, key="cd_staging",
                              value=F.when(k < 70, F.lit("pass")).otherwise(F.lit("fail")))))
             .when((F.col("event_type") == "error") & (k < 50),
                   F.array(mk("delete_alias", alias="candidate")))
             .when((F.col("event_type") == "error") & (k == 99), F.array(mk("delete_model")))
             .when(F.col("event_type") == "error",
                   F.array(mk("delete_version", (F.lit(1) + k % 5).cast("string")))))
    x = e.select("model", "seq", "ts", F.explode(items).alias("x"))
    return x.select("model", "seq", "ts", "x.kind", "x.version", "x.alias", "x.tag_key",
                    "x.tag_value",
                    F.concat(F.lit("run-"), F.col("seq").cast("string")).alias("run_id"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversation turns with token estimates and a reset marker."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return turns_from(c)


def turns_from(c: DataFrame) -> DataFrame:
    """F6 projection of a conversations frame (batch or streaming)."""
    return c.select(
        "conv_id", "turn", "role", "text",
        approx_tokens(word_count("text")).alias("tokens"),
        (((F.col("conv_id") * 7919 + F.col("turn") * 104729) % 90010) / F.lit(10.0)).alias("latency_ms"),
        ((F.col("role") == "user") & (F.length("text") % 7 == 0)).alias("is_reset"),
        F.col("conv_id").alias("parent_run_id"),
    )


def few_shots_col():
    return F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content"))
                     for r, c in FEW_SHOTS])


def tabular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: lineitem as a regression table with two fixed prediction columns."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_discount", "l_tax", "l_shipdate", "l_extendedprice"])
    rid = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return li.select(
        rid.alias("row_id"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_discount").cast("double").alias("discount"),
        F.col("l_tax").cast("double").alias("tax"),
        F.month("l_shipdate").cast("double").alias("ship_month"),
        F.year("l_shipdate").cast("double").alias("ship_year"),
        F.col("l_extendedprice").cast("double").alias("label"),
        (F.col("l_quantity") * 1500.0).alias("p1"),
        (F.col("l_quantity") * 1500.0 * (F.lit(1.0) - F.col("l_discount"))).alias("p2"),
    )


TABULAR_FEATURES = ["quantity", "discount", "tax", "ship_month", "ship_year"]


def tabular_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 with a unique ``row_uid``: the row key plus an occurrence number
    among rows sharing it (the key alone repeats at small scale).  Groups are
    the duplicates of one key, so the window partitions stay tiny."""
    from pyspark.sql import Window
    t = tabular(spark, sf_dir)
    w = Window.partitionBy("row_id").orderBy("quantity", "discount", "tax", "ship_month",
                                             "ship_year", "label")
    return t.withColumn("row_uid", F.concat_ws("#", "row_id",
                                               F.row_number().over(w).cast("string")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embedding vectors with their class label."""
    return read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tool calls, session ids and textual metric values from events."""
    e = read_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.select(
        F.col("event_id").alias("call_id"), "ts", "user_id",
        F.concat(F.lit("cat__sch__"), F.col("event_type")).alias("name"),
        F.when(F.col("event_id") % 50 == 0, F.lit("{bad"))
        .when(F.col("event_id") % 70 == 0, F.concat(F.col("props"), F.lit(" junk"))).otherwise(F.col("props")).alias("arguments"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("s"), F.col("user_id").cast("string")))
        .alias("custom_session"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("context_conversation"),
        F.when(F.col("event_id") % 40 == 0, F.lit("n/a"))
        .otherwise(F.col("value").cast("string")).alias("metric_value"),
    )
