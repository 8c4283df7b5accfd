"""Config hash, run names, template rows of the test corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.text import col


def _json_char(ch: Column) -> Column:
    """One character as Python's ``json`` writes it with ASCII output."""
    code = F.ascii(ch)
    u = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
    high = F.shiftright(code - 0x10000, 10) + 0xD800
    low = (code - 0x10000).bitwiseAND(F.lit(0x3FF)) + 0xDC00
    short = F.create_map(*[F.lit(x) for pair in (
        ('"', '\\"'), ("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"), ("\b", "\\b"))
        for x in pair])
    return (F.when(F.try_element_at(short, ch).isNotNull(), F.try_element_at(short, ch))
            .when((code >= 32) & (code < 127), ch)
            .when(code < 0x10000, u(code))
            .otherwise(F.concat(u(high), u(low))))


def json_str(c) -> Column:
    """A string column as Python's ``json.dumps`` writes it: quoted, escaped
    to ASCII, NULL as ``null``."""
    text = col(c)
    escaped = F.array_join(F.transform(F.split(text, ""), _json_char), "")
    plain = text.rlike(r"^[ !#-\[\]-~]*$")
    return F.when(text.isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.when(plain, text).otherwise(escaped), F.lit('"')))


def json_float(c) -> Column:
    """A double as Python's ``repr`` writes it (positional from 1e-4 up to
    1e16, else with a two-digit exponent); NULL as ``null``.  The digits are
    the JVM's, which before JDK 19 are not the shortest for a few huge values."""
    s = col(c).cast("double").cast("string")
    sign = F.when(F.startswith(s, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_extract(s, r"^-?([0-9.]+)E", 1)
    e = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), r"(?<=.)0+$", "")
    whole = F.concat(F.substring(F.rpad(digits, 17, "0"), F.lit(1), e + 1), F.lit("."),
                     F.when(F.length(digits) > e + 1, F.substring(digits, e + 2, F.lit(17))).otherwise(F.lit("0")))
    science = F.concat(F.regexp_replace(mantissa, r"\.0$", ""), F.lit("e"),
                       F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                       F.regexp_replace(F.abs(e).cast("string"), r"^(\d)$", "0$1"))
    return (F.when(s.isNull(), F.lit("null")).when(~F.contains(s, F.lit("E")), s)
            .when(e == -4, F.concat(sign, F.lit("0.000"), digits))
            .when((e >= 0) & (e < 16), F.concat(sign, whole))
            .otherwise(F.concat(sign, science)))


def canonical_config(df: DataFrame) -> Column:
    """Sorted-key JSON of a template row with ``", "`` / ``": "`` separators:
    few_shots, max_tokens, model, name, system, temperature, version."""
    shots = F.concat(F.lit("["), F.array_join(F.transform(
        F.coalesce(F.col("few_shots"), F.array().cast("array<struct<role:string,content:string>>")),
        lambda m: F.concat(F.lit('{"content": '), json_str(m["content"]),
                           F.lit(', "role": '), json_str(m["role"]), F.lit("}"))), ", "), F.lit("]"))
    return F.concat(
        F.lit('{"few_shots": '), shots,
        F.lit(', "max_tokens": '), F.coalesce(F.col("max_tokens").cast("string"), F.lit("null")),
        F.lit(', "model": '), json_str("model"),
        F.lit(', "name": '), json_str("name"),
        F.lit(', "system": '), json_str("system"),
        F.lit(', "temperature": '), json_float("temperature"),
        F.lit(', "version": '), json_str("version"),
        F.lit("}"))


def config_hash(df: DataFrame) -> Column:
    """First 12 hex characters of sha-256 over the canonical config."""
    return F.substring(F.sha2(canonical_config(df), 256), 1, D.CONFIG_HASH_CHARS)


def experiment_run_name(name, version, chash) -> Column:
    return F.concat(col(name), F.lit("-v"), col(version), F.lit("-"), col(chash))


def _sha8(sha) -> Column:
    return F.substring(col(sha), 1, D.RUN_SHA_CHARS)


def ci_run_name(sha, passed) -> Column:
    return F.concat(F.lit("ci-"), _sha8(sha), F.lit("-"),
                    F.when(col(passed), F.lit("pass")).otherwise(F.lit("fail")))


def cd_staging_run_name(sha, passed) -> Column:
    return F.concat(F.lit("cd-staging-"), _sha8(sha), F.lit("-"),
                    F.when(col(passed), F.lit("pass")).otherwise(F.lit("fail")))


def cd_production_run_name(sha) -> Column:
    return F.concat(F.lit("cd-production-"), _sha8(sha))


def cc_run_name(sha, promoted) -> Column:
    return F.concat(F.lit("cc-"), F.when(col(promoted), F.lit("promoted")).otherwise(F.lit("retained")),
                    F.lit("-"), _sha8(sha))


def corpus_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template config rows for the corpus: one per document source."""
    from arbiter.sources.tables import read_table
    return template_rows(read_table(spark, sf_dir, "documents", ["source"]).distinct())


def template_rows(sources: DataFrame) -> DataFrame:
    """Config of the template that answered for a ``source``."""
    ord_ = F.substring("source", 4, 16).cast("int")
    return sources.select(
        F.col("source").alias("name"),
        F.concat(F.lit("1.0."), F.substring("source", 4, 16)).alias("version"),
        F.concat(F.lit("You are support agent "), F.col("source")).alias("system"),
        F.concat(F.lit("model-"), (ord_ % 3).cast("string")).alias("model"),
        F.lit(D.TEMPLATE_TEMPERATURE).alias("temperature"),
        F.lit(D.TEMPLATE_MAX_TOKENS).cast("int").alias("max_tokens"),
        F.array().cast("array<struct<role:string,content:string>>").alias("few_shots"),
        ord_.alias("ord"))
