"""Evaluation of recorded responses against their golden cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.rules import rule_columns, token_cost
from arbiter.operators.common import bounded_broadcast


def attach_cases(responses: DataFrame, cases: DataFrame, key: str = "case_id") -> DataFrame:
    """response_case_join: each response meets its own case (broadcast side)."""
    return responses.join(bounded_broadcast(cases), key, "inner")


def evaluate_responses(responses: DataFrame, cases: DataFrame,
                       cta_phrase: str = D.CTA_PHRASE, with_cost: bool = False,
                       per_1k_in: float = D.PER_1K_INPUT_USD,
                       per_1k_out: float = D.PER_1K_OUTPUT_USD) -> DataFrame:
    """Rule-evaluate every response: join cases, then one projection of rule
    columns over the lowered text.  Optional per-case cost (6 decimals)."""
    joined = attach_cases(responses, cases)
    out = rule_columns(joined, cta_phrase=cta_phrase)
    if with_cost:
        out = out.withColumn("cost_usd", token_cost("input_tokens", "output_tokens",
                                                    per_1k_in, per_1k_out))
    return out


def experiment_grid(templates: DataFrame, cases: DataFrame, parts: int = 16) -> DataFrame:
    """Every template x every case, for any number of either.  The grid is
    the result asked for; it is made by an equi-join: each case gets one of
    ``parts`` hash parts, each template a row per part, so the work is spread
    and nothing passes through the driver or the plan."""
    left = templates.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))
    right = cases.withColumn("_part", F.pmod(F.xxhash64(*cases.columns), F.lit(parts)))
    return left.join(right, "_part").drop("_part")
