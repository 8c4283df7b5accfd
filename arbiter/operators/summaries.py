"""Per-template summaries, composite score, quality gates, smoke summary.

All aggregates are single ``groupBy`` jobs: Spark's partial aggregation
combines map-side, so a template holding a third of the rows costs one
partial row per map task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter import schemas as S
from arbiter.functions.rules import composite, exact_mean
from arbiter.operators.common import bounded_broadcast
from arbiter.sources.local import local_table

JUDGE_AVG_COLS = ("judge_helpfulness", "judge_faithfulness", "judge_conciseness",
                  "judge_safety")


def experiment_summary(evaluated: DataFrame, keys=("template", "ord"),
                       with_judge: bool = False) -> DataFrame:
    """Rule pass rate, mean (3-decimal) case score, mean latency and tokens per
    template.  With judge columns: judge means over judged rows + n_judged;
    ``avg_judge_score`` is the 0.0 sentinel when no row was judged."""
    aggs = [
        F.count(F.lit(1)).alias("n_cases"),
        F.avg(F.col("passed").cast("int")).alias("rule_pass_rate"),
        exact_mean("score", D.RULE_SCORE_DECIMALS).alias("avg_rule_score"),
        exact_mean("latency_ms", 1).alias("avg_latency_ms"),
        F.avg("input_tokens").alias("avg_input_tokens"),
        F.avg("output_tokens").alias("avg_output_tokens"),
    ]
    if with_judge:
        aggs += [F.count("judge_avg").alias("n_judged"),
                 F.coalesce(exact_mean("judge_avg", D.JUDGE_AVG_DECIMALS), F.lit(0.0))
                 .alias("avg_judge_score")]
        aggs += [F.avg(c).alias(f"avg_{c}") for c in JUDGE_AVG_COLS]
    out = evaluated.groupBy(*keys).agg(*aggs)
    if not with_judge:
        out = out.withColumn("avg_judge_score", F.lit(0.0))
    return out.withColumn("composite", composite("avg_rule_score", "avg_judge_score"))


def ci_summary(evaluated: DataFrame, keys=("template",)) -> DataFrame:
    """CI aggregate: as the experiment summary plus mean 6-decimal cost and
    total tokens."""
    return evaluated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.avg(F.col("passed").cast("int")).alias("rule_pass_rate"),
        exact_mean("score", D.RULE_SCORE_DECIMALS).alias("avg_rule_score"),
        exact_mean("latency_ms", 1).alias("avg_latency_ms"),
        exact_mean("cost_usd", D.COST_DECIMALS).alias("avg_cost_usd"),
        F.sum("input_tokens").cast("bigint").alias("total_in_tokens"),
        F.sum("output_tokens").cast("bigint").alias("total_out_tokens"),
    )


def gate_table(spark: SparkSession, rule_pass_rate: float = D.GATE_RULE_PASS_RATE,
               avg_latency_ms: float = D.GATE_AVG_LATENCY_MS,
               avg_cost_usd: float = D.GATE_AVG_COST_USD) -> DataFrame:
    """The CI gates as a long config table (gate, metric, direction, threshold)."""
    rows = [("rule_pass_rate", "rule_pass_rate", ">=", float(rule_pass_rate), 0),
            ("avg_latency_ms", "avg_latency_ms", "<=", float(avg_latency_ms), 1),
            ("avg_cost_usd", "avg_cost_usd", "<=", float(avg_cost_usd), 2)]
    return local_table(spark, rows, S.GATE)


def gate_verdicts(summary: DataFrame, gates: DataFrame, keys=("template",)) -> DataFrame:
    """Long table of gate results per summary row: unpivot the metrics, join the
    thresholds by metric name, compare inclusively on unrounded values."""
    metrics = [r for r in ("rule_pass_rate", "avg_latency_ms", "avg_cost_usd")
               if r in summary.columns]
    long = summary.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(keys), metrics, "metric", "actual")
    j = long.join(bounded_broadcast(gates), "metric", "inner")
    passed = (F.when(F.col("direction") == ">=", F.col("actual") >= F.col("threshold"))
              .otherwise(F.col("actual") <= F.col("threshold")))
    return j.select(*keys, "gate", "gate_ord", "direction", "threshold", "actual",
                    passed.alias("passed"))


def gate_rollup(verdicts: DataFrame, keys=("template",)) -> DataFrame:
    """All-passed, n passed, n total, and the failed gate names in gate order."""
    failed = F.sort_array(F.collect_list(
        F.when(~F.col("passed"), F.struct("gate_ord", "gate"))))
    return verdicts.groupBy(*keys).agg(
        F.bool_and("passed").alias("all_passed"),
        F.count_if("passed").cast("bigint").alias("n_gates_passed"),
        F.count(F.lit(1)).cast("bigint").alias("n_gates_total"),
        F.array_join(F.transform(failed, lambda s: s["gate"]), ",").alias("gates_failed"),
        *[F.max(F.when(F.col("gate") == g, F.col("passed").cast("int"))).alias(f"gate_{g}")
          for g in ("rule_pass_rate", "avg_latency_ms", "avg_cost_usd")],
    )


def probe_checks(replies: DataFrame, probes: DataFrame, reply: str = "response",
                 latency: str = "latency_ms") -> DataFrame:
    """Smoke probe verdict per reply: all must_contain present, no must_not
    present, latency within the probe's limit (default 8000 ms)."""
    j = replies.join(bounded_broadcast(probes), "probe_id", "inner")
    lowered = j.select("*", F.lower(F.col(reply)).alias("_lc"))
    must = F.coalesce(F.col("must_contain"), F.array().cast("array<string>"))
    must_not = F.coalesce(F.col("must_not_contain"), F.array().cast("array<string>"))
    lc = F.col("_lc")
    out = lowered.select(
        "*",
        F.forall(must, lambda k: F.contains(lc, F.lower(k))).alias("contains_ok"),
        (~F.exists(must_not, lambda k: F.contains(lc, F.lower(k)))).alias("not_contains_ok"),
        (F.col(latency) <= F.coalesce(F.col("max_latency_ms"),
                                      F.lit(D.PROBE_MAX_LATENCY_MS))).alias("latency_ok"),
        F.filter(must, lambda k: ~F.contains(lc, F.lower(k))).alias("missing"),
        F.filter(must_not, lambda k: F.contains(lc, F.lower(k))).alias("violating"),
        F.substring(F.col(reply), 1, D.SNIPPET_CHARS).alias("reply_snippet"),
    ).drop("_lc")
    return out.withColumn("passed", F.col("contains_ok") & F.col("not_contains_ok") &
                          F.col("latency_ok"))


def smoke_summary(checked: DataFrame, keys=("template",)) -> DataFrame:
    """All passed (empty set -> not passed), pass rate and mean latency."""
    return checked.groupBy(*keys).agg(
        (F.coalesce(F.bool_and("passed"), F.lit(False)) & (F.count(F.lit(1)) > 0)).alias("all_passed"),
        F.avg(F.col("passed").cast("int")).alias("smoke_pass_rate"),
        exact_mean("latency_ms", 1).alias("avg_latency_ms"),
        F.count(F.lit(1)).alias("n_probes"),
    )
