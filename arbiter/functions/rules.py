"""Rule evaluator columns (topic hits, violations, word limit, CTA, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.rounding import exact_round
from arbiter.functions.text import absent, col, present, word_count

LOWER = "_resp_lower"


def rule_columns(df: DataFrame, response: str = "response",
                 topics: str = "expected_topics", must_not: str = "must_not_contain",
                 max_words: str = "max_words", cta_phrase: str = D.CTA_PHRASE,
                 keep: bool = True) -> DataFrame:
    """Add the rule evaluation of ``response`` against its case's lists.

    The lowered response is projected once and read by the hit, miss,
    violation and CTA expressions of one ``select`` so Catalyst keeps it as a
    shared projection instead of re-lowering the text inside each lambda.
    """
    lowered = df.select("*", F.lower(F.col(response)).alias(LOWER))
    hits = present(topics, LOWER)
    n_topics = F.size(F.col(topics))
    viol = present(must_not, LOWER)
    cta = F.contains(F.col(LOWER), F.lower(F.lit(cta_phrase)))
    wc = word_count(response)
    out = lowered.select(
        "*",
        F.size(hits).cast("bigint").alias("topic_hits"),
        absent(topics, LOWER).alias("topic_misses"),
        viol.alias("must_not_violated"),
        wc.alias("word_count"),
        cta.alias("ends_with_cta"),
        n_topics.alias("_n_topics"),
    )
    raw = rule_score_raw(F.col("topic_hits"), F.col("_n_topics"),
                         F.size("must_not_violated"), F.col("ends_with_cta"))
    out = out.select(
        "*",
        (F.col("word_count") <= F.col(max_words)).alias("within_word_limit"),
        raw.alias("_score_raw"),
    )
    out = out.select(
        *[c for c in out.columns if c not in (LOWER, "_n_topics", "_score_raw")],
        ((F.col("_score_raw") >= F.lit(D.PASS_SCORE)) &
         (F.size("must_not_violated") == 0)).alias("passed"),
        exact_round("_score_raw", D.RULE_SCORE_DECIMALS).alias("score"),
    )
    if not keep:
        out = out.drop(response)
    return out


def rule_score_raw(hits: Column, n_topics: Column, n_violations: Column, cta: Column,
                   penalty: float = D.VIOLATION_PENALTY, bonus: float = D.CTA_BONUS) -> Column:
    """max(0, min(1, hits/max(n,1) - penalty*violations + bonus*cta)), unrounded."""
    topic_score = hits.cast("double") / F.greatest(n_topics, F.lit(1)).cast("double")
    value = (topic_score - n_violations.cast("double") * F.lit(float(penalty))) + \
        F.when(cta, F.lit(float(bonus))).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def token_cost(input_tokens, output_tokens, per_1k_in: float = D.PER_1K_INPUT_USD,
               per_1k_out: float = D.PER_1K_OUTPUT_USD, rounded: bool = True) -> Column:
    """in/1000*p_in + out/1000*p_out (stored rounded to 6 decimals)."""
    if isinstance(input_tokens, str) and isinstance(output_tokens, str):
        sql = (f"((CAST(`{input_tokens}` AS DOUBLE) / CAST(1000.0 AS DOUBLE)) * CAST({float(per_1k_in)!r} AS DOUBLE)"
               f" + (CAST(`{output_tokens}` AS DOUBLE) / CAST(1000.0 AS DOUBLE)) * CAST({float(per_1k_out)!r} AS DOUBLE))")
        return exact_round(sql, D.COST_DECIMALS) if rounded else F.expr(sql)
    cost = (col(input_tokens).cast("double") / F.lit(1000.0)) * F.lit(float(per_1k_in)) + \
        (col(output_tokens).cast("double") / F.lit(1000.0)) * F.lit(float(per_1k_out))
    return exact_round(cost, D.COST_DECIMALS) if rounded else cost


def composite(avg_rule, avg_judge) -> Column:
    """0.5*rule + 0.5*judge/5, or rule alone when the judge sentinel is 0."""
    r, j = col(avg_rule), col(avg_judge)
    return F.when(F.coalesce(j, F.lit(0.0)) != 0.0,
                  r * F.lit(0.5) + (j / F.lit(D.JUDGE_SCALE)) * F.lit(0.5)).otherwise(r)


def exact_mean(c, decimals: int) -> Column:
    """Mean of values stored at ``decimals`` places, as an exact integer sum
    divided once: the result does not depend on partitioning or summation
    order (a plain double ``avg`` does, in its last bits)."""
    scale = 10 ** decimals
    total = F.sum(F.round(col(c) * F.lit(float(scale))).cast("bigint"))
    return total.cast("double") / (F.count(col(c)) * F.lit(scale)).cast("double")
