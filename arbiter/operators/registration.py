"""Registry writes of the first three phases: candidate registration after
the experiment, CI result after the gates, staging result after the probes.

Every function returns rows of writes (model, ev_ord, kind, version, run_id,
alias, tag_key, tag_value); :func:`append` gives them sequence numbers behind
those of a log, so the state queries read them like any other event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions import hashing as H

WRITE = ["model", "ev_ord", "kind", "version", "run_id", "alias", "tag_key", "tag_value"]


def _writes(df: DataFrame, *events: Column) -> DataFrame:
    x = df.select("model", F.col("version").cast("string").alias("version"), "run_id",
                  F.posexplode(F.array(*events)).alias("ev_ord", "e"))
    return x.select("model", F.col("ev_ord").cast("int").alias("ev_ord"), "e.kind", "version", "run_id",
                    "e.alias", "e.tag_key", "e.tag_value")


def _event(kind: str, alias: str | None = None, key: str | None = None, value: Column | None = None) -> Column:
    text = lambda v: F.lit(v).cast("string")
    return F.struct(F.lit(kind).alias("kind"), text(alias).alias("alias"), text(key).alias("tag_key"),
                    (text(None) if value is None else value.cast("string")).alias("tag_value"))


def candidate_events(best: DataFrame, log: DataFrame) -> DataFrame:
    """Registration of the best template of each model as its next version
    (one above the highest ever given), and the candidate alias on it.

    ``best``: model, template, run_id; at most one row per model."""
    from arbiter.operators.registry import highest_version
    numbered = best.join(highest_version(log), "model", "left").withColumn(
        "version", F.coalesce("highest_version", F.lit(0)) + 1)
    return _writes(numbered, _event("register"), _event("set_alias", alias="candidate"),
                   _event("set_tag", key="template_name", value=F.col("template")))


def ci_events(candidates: DataFrame, gates: DataFrame) -> DataFrame:
    """``ci_last_result`` and ``ci_last_run_id`` of the candidates, from the
    gates of their templates; a template without gates has not passed."""
    passed = F.coalesce("all_passed", F.lit(False))
    x = candidates.join(gates.select("template", "all_passed"), "template", "left")
    return _writes(x, _event("set_tag", key="ci_last_result",
                             value=F.when(passed, F.lit("pass")).otherwise(F.lit("fail"))),
                   _event("set_tag", key="ci_last_run_id", value=H.ci_run_name(F.md5("template"), passed)))


def staging_events(candidates: DataFrame, smoke: DataFrame) -> DataFrame:
    """The staging tag of the candidates, from the probes of their templates;
    a template without probes has not passed."""
    x = candidates.join(smoke.select("template", "all_passed"), "template", "left")
    value = F.when(F.coalesce("all_passed", F.lit(False)), F.lit(D.STAGING_PASS)).otherwise(F.lit("fail"))
    return _writes(x, _event("set_tag", key=D.STAGING_TAG, value=value))


def number_writes(log: DataFrame, *batches: DataFrame) -> DataFrame:
    """The writes of each batch, in order, as events behind those of the log.
    Numbers are dealt per model (a state query never compares two models)."""
    last = log.groupBy("model").agg(F.max("seq").alias("_last"))
    new = None
    for i, batch in enumerate(batches):
        part = batch.select(F.lit(i).alias("_batch"), *WRITE)
        new = part if new is None else new.unionByName(part)
    order = Window.partitionBy("model").orderBy("_batch", "ev_ord")   # a handful of writes per model
    rows = new.join(last, "model", "left").withColumn(
        "seq", F.coalesce("_last", F.lit(-1)) + F.row_number().over(order))
    return rows.select(*[F.col(c).cast(log.schema[c].dataType) for c in log.columns if c in (*WRITE, "seq")])


def append(log: DataFrame, *batches: DataFrame) -> DataFrame:
    """The log with the writes of each batch behind it."""
    rows = number_writes(log, *batches)
    return log.select(*rows.columns).unionByName(rows)
