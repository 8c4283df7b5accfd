"""Declarative config (cases, probes, templates) as typed tables.

Config files are JSON lines read with an explicit schema; defaults are
filled with ``coalesce`` and values cast to the declared types.  An empty
case or template set is rejected on the driver after a bounded check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter import schemas as S
from arbiter.sources.local import local_table

CASE_FILE_SCHEMA = "id STRING, user_message STRING, expected_topics ARRAY<STRING>, " \
                   "must_not_contain ARRAY<STRING>, max_words BIGINT"
TEMPLATE_FILE_SCHEMA = ("name STRING, version STRING, system STRING, model STRING, "
                        "temperature DOUBLE, max_tokens BIGINT, "
                        "few_shots ARRAY<STRUCT<role: STRING, content: STRING>>")


def default_fill(c, default) -> Column:
    """``x or default``: NULL and empty string both fall back."""
    if isinstance(default, str):
        return F.coalesce(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit(default))
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def load_cases(spark: SparkSession, path: str, max_words_default: int = 160) -> DataFrame:
    """Golden cases from JSON lines: id -> case_id, absent lists -> [], absent
    word limit -> default, typed as ``schemas.GOLDEN_CASE``."""
    raw = spark.read.schema(CASE_FILE_SCHEMA).json(path)
    empty = F.array().cast("array<string>")
    cases = raw.select(
        F.col("id").alias("case_id"),
        default_fill("user_message", "").alias("user_message"),
        F.coalesce("expected_topics", empty).alias("expected_topics"),
        F.coalesce("must_not_contain", empty).alias("must_not_contain"),
        F.coalesce("max_words", F.lit(max_words_default)).cast("int").alias("max_words"))
    return cases.select(*[F.col(f.name).cast(f.dataType) for f in S.GOLDEN_CASE.fields])


def load_templates(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(TEMPLATE_FILE_SCHEMA).json(path)
    return raw.select(
        "name",
        default_fill("version", D.TEMPLATE_VERSION).alias("version"),
        "system",
        "model",
        F.coalesce("temperature", F.lit(D.TEMPLATE_TEMPERATURE)).cast("double").alias("temperature"),
        F.coalesce("max_tokens", F.lit(D.TEMPLATE_MAX_TOKENS)).cast("int").alias("max_tokens"),
        F.coalesce("few_shots", F.array().cast("array<struct<role:string,content:string>>"))
        .alias("few_shots"))


PROBE_FILE_SCHEMA = ("id STRING, user_message STRING, must_contain ARRAY<STRING>, "
                     "must_not_contain ARRAY<STRING>, max_latency_ms DOUBLE")


def load_probes(spark: SparkSession, path: str) -> DataFrame:
    """Smoke probes from JSON lines: absent lists -> [], an absent latency
    limit -> the default, typed as ``schemas.SMOKE_PROBE``."""
    raw = spark.read.schema(PROBE_FILE_SCHEMA).json(path)
    empty = F.array().cast("array<string>")
    probes = raw.select(
        F.col("id").alias("probe_id"), default_fill("user_message", "").alias("user_message"),
        F.coalesce("must_contain", empty).alias("must_contain"),
        F.coalesce("must_not_contain", empty).alias("must_not_contain"),
        F.coalesce("max_latency_ms", F.lit(float(D.PROBE_MAX_LATENCY_MS))).alias("max_latency_ms"))
    return probes.select(*[F.col(f.name).cast(f.dataType) for f in S.SMOKE_PROBE.fields])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Reject an empty config set (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"config must define at least one {what}")
    return df


def missing_keys(present_map: Column, required: list[str]) -> Column:
    """Required keys absent from a map column (set difference, in required order)."""
    return F.array_except(F.array(*[F.lit(k) for k in required]), F.map_keys(present_map))


def write_cases(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Write literal case rows as a JSON-lines config file."""
    df = local_table(spark, rows, S.GOLDEN_CASE).select(
        F.col("case_id").alias("id"), "user_message", "expected_topics", "must_not_contain",
        "max_words")
    df.coalesce(1).write.mode("overwrite").json(path)
