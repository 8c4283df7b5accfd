"""StructTypes of the engine's entities (config, results, registry, telemetry)."""

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)
STRINGS = T.ArrayType(T.StringType())

TEMPLATE = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.StringType()),
    T.StructField("system", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("max_tokens", T.IntegerType()),
    T.StructField("few_shots", MESSAGES),
    T.StructField("ord", T.IntegerType()),
])

GOLDEN_CASE = T.StructType([
    T.StructField("case_id", T.StringType(), False),
    T.StructField("user_message", T.StringType()),
    T.StructField("expected_topics", STRINGS),
    T.StructField("must_not_contain", STRINGS),
    T.StructField("max_words", T.IntegerType()),
])

SMOKE_PROBE = T.StructType([
    T.StructField("probe_id", T.StringType(), False),
    T.StructField("user_message", T.StringType()),
    T.StructField("must_contain", STRINGS),
    T.StructField("must_not_contain", STRINGS),
    T.StructField("max_latency_ms", T.DoubleType()),
])

GATE = T.StructType([
    T.StructField("gate", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("direction", T.StringType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("gate_ord", T.IntegerType(), False),
])

JUDGE_SCORES = T.StructType([
    T.StructField("helpfulness", T.DoubleType()),
    T.StructField("faithfulness", T.DoubleType()),
    T.StructField("conciseness", T.DoubleType()),
    T.StructField("safety", T.DoubleType()),
    T.StructField("reasoning", T.StringType()),
])

REGISTRY_EVENT = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts", T.TimestampType()),
    T.StructField("kind", T.StringType(), False),
    T.StructField("version", T.StringType()),
    T.StructField("alias", T.StringType()),
    T.StructField("tag_key", T.StringType()),
    T.StructField("tag_value", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

AUDIT = T.StructType([T.StructField(c, T.StringType()) for c in (
    "event", "cd_run_id", "model_name", "model_version", "prev_production_version",
    "template_name", "template_version", "llm_model", "approved_by", "git_sha",
    "git_ref", "deployed_at")])

RUN_METRIC = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.DoubleType()),
    T.StructField("step", T.LongType()),
])

TOOL = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("description", T.StringType()),
])

PROMPT = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("template", T.StringType()),
    T.StructField("alias", T.StringType()),
])
