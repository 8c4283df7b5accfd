"""Champion / challenger: per-side summaries, paired comparison, decision,
and the registry writes that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.rounding import exact_round
from arbiter.functions.rules import exact_mean
from arbiter.functions.text import col
from arbiter.operators.common import bounded_broadcast


def py_float_str(x, decimals: int = 4) -> Column:
    """``str(round(x, n))`` for values rounded to n decimals: fixed notation,
    trailing zeros dropped, at least one digit after the point."""
    fixed = F.format_string(f"%.{decimals}f", col(x))
    trimmed = F.regexp_replace(fixed, "0+$", "")
    return F.regexp_replace(trimmed, r"\.$", ".0")


def side_summary(evaluated_judged: DataFrame, keys=("template",)) -> DataFrame:
    """Phase-4 per-side result: means rounded as logged (4 / 1 / 6 decimals),
    composite = 0.5 rule + 0.5 judge/5 from unrounded means, rounded to 4."""
    s = evaluated_judged.groupBy(*keys).agg(
        F.avg(F.col("passed").cast("int")).alias("_pr"),
        exact_mean("score", D.RULE_SCORE_DECIMALS).alias("_rs"),
        F.coalesce(exact_mean("judge_avg", D.JUDGE_AVG_DECIMALS), F.lit(0.0)).alias("_js"),
        exact_mean("latency_ms", 1).alias("_lat"),
        exact_mean("cost_usd", D.COST_DECIMALS).alias("_cost"))
    comp = f"(`_rs` * CAST(0.5 AS DOUBLE) + (`_js` / CAST({D.JUDGE_SCALE} AS DOUBLE)) * CAST(0.5 AS DOUBLE))"
    return s.select(*keys,
                    exact_round("_pr", 4).alias("rule_pass_rate"),
                    exact_round("_rs", 4).alias("avg_rule_score"),
                    exact_round("_js", 4).alias("avg_judge_score"),
                    exact_round("_lat", 1).alias("avg_latency_ms"),
                    exact_round("_cost", 6).alias("avg_cost_usd"),
                    exact_round(comp, 4).alias("composite"))


def attach_sides(pairs: DataFrame, side_results: DataFrame, key: str = "template",
                 pair_key: str = "model") -> DataFrame:
    """pairs(champ_<key>, chall_<key>) with both sides' results attached.

    The pair is exploded into its two sides, joined with the results once
    (per-template results: small, size-checked broadcast) and folded back to
    one row per pair, so the results pipeline is planned and run once."""
    r = bounded_broadcast(side_results)
    metrics = [c for c in side_results.columns if c != key]
    cols = pairs.columns
    sides = pairs.select(*cols, F.explode(F.array(
        F.struct(F.lit("champ").alias("_side"), F.col(f"champ_{key}").alias("_k")),
        F.struct(F.lit("chall").alias("_side"), F.col(f"chall_{key}").alias("_k")))).alias("_s")
    ).select(*cols, "_s._side", F.col("_s._k").alias(key))
    j = sides.join(r, key, "inner")
    folded = j.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.when(F.col("_side") == side, F.col(m))).alias(f"{side}_{m}")
          for side in ("champ", "chall") for m in metrics])
    return folded.where(F.col("_n") == 2).drop("_n")


def promotion_decision(sides: DataFrame, min_improvement: float = D.CC_MIN_IMPROVEMENT) -> DataFrame:
    """delta = challenger - champion (rounded composites); promote iff delta >
    min_improvement (strict, in DOUBLE).  Keeps latency and cost deltas."""
    delta = F.col("chall_composite") - F.col("champ_composite")
    return sides.select(
        "*",
        delta.alias("delta"),
        (delta > F.lit(float(min_improvement))).alias("promote"),
        (F.col("chall_avg_latency_ms") - F.col("champ_avg_latency_ms")).alias("latency_delta"),
        (F.col("chall_avg_cost_usd") - F.col("champ_avg_cost_usd")).alias("cost_delta"),
        F.concat(F.lit("delta="), F.format_string("%+.4f", delta),
                 F.lit(f" did not exceed min_improvement={min_improvement}")).alias("reason"))


def promotion_events(decisions: DataFrame, evaluated_at: str) -> DataFrame:
    """Registry writes for promote vs retain, one row per write in order."""
    def ev(kind, version, alias=None, key=None, value=None):
        return F.struct(F.lit(kind).alias("kind"), col(version).cast("string").alias("version"),
                        F.lit(alias).cast("string").alias("alias"),
                        F.lit(key).cast("string").alias("tag_key"),
                        (value if isinstance(value, Column) else F.lit(value)).cast("string")
                        .alias("tag_value"))
    promote = F.array(
        ev("set_alias", "chall_version", alias="champion"),
        ev("set_tag", "chall_version", key="cc_result", value="promoted_to_champion"),
        ev("set_tag", "chall_version", key="cc_promoted_at", value=evaluated_at),
        ev("set_tag", "chall_version", key="cc_score_delta", value=py_float_str(exact_round("delta", 4))),
        ev("set_tag", "chall_version", key="cc_replaced_champ", value=F.col("champ_version")),
        ev("set_tag", "champ_version", key="cc_result", value="retired_by_challenger"))
    retain = F.array(
        ev("set_tag", "chall_version", key="cc_result", value="not_promoted"),
        ev("set_tag", "chall_version", key="cc_rejection_reason", value=F.col("reason")),
        ev("set_alias", "champ_version", alias="champion"))
    x = decisions.select("model", F.posexplode(F.when(F.col("promote"), promote).otherwise(retain))
                         .alias("ev_ord", "e"))
    return x.select("model", F.col("ev_ord").cast("int").alias("ev_ord"), "e.kind", "e.version",
                    "e.alias", "e.tag_key", "e.tag_value")


def deployment_events(cands: DataFrame, deployed_at: str, approved_by: str) -> DataFrame:
    """Production deployment writes: alias + four tags (+ replaced version)."""
    def ev(kind, alias=None, key=None, value=None):
        return F.struct(F.lit(kind).alias("kind"), F.col("version").cast("string").alias("version"),
                        F.lit(alias).cast("string").alias("alias"),
                        F.lit(key).cast("string").alias("tag_key"),
                        (value if isinstance(value, Column) else F.lit(value)).cast("string")
                        .alias("tag_value"))
    base = F.array(
        ev("set_alias", alias="production"),
        ev("set_tag", key="cd_production", value="deployed"),
        ev("set_tag", key="cd_deployed_at", value=deployed_at),
        ev("set_tag", key="cd_approved_by", value=approved_by),
        ev("set_tag", key="cd_git_sha", value=F.col("git_sha")))
    replaced = F.array(ev("set_tag", key="cd_replaced_version", value=F.col("prev_version")))
    items = F.when(F.col("prev_version").isNotNull(), F.concat(base, replaced)).otherwise(base)
    x = cands.select("model", F.posexplode(items).alias("ev_ord", "e"))
    return x.select("model", F.col("ev_ord").cast("int").alias("ev_ord"), "e.kind", "e.version",
                    "e.alias", "e.tag_key", "e.tag_value")


def audit_rows(cands: DataFrame, deployed_at: str, approved_by: str,
               git_ref: str = "refs/heads/main") -> DataFrame:
    """Immutable audit record per production deployment (12 string fields)."""
    return cands.select(
        F.lit("production_deployment").alias("event"),
        F.concat(F.lit("cd-production-"), F.substring("git_sha", 1, D.RUN_SHA_CHARS)).alias("cd_run_id"),
        F.col("model").alias("model_name"),
        F.col("version").alias("model_version"),
        F.col("prev_version").alias("prev_production_version"),
        F.col("template_name"), F.col("template_version"), F.col("llm_model"),
        F.lit(approved_by).alias("approved_by"), F.col("git_sha"), F.lit(git_ref).alias("git_ref"),
        F.lit(deployed_at).alias("deployed_at"))
