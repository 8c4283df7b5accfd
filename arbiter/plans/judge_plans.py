"""Judge path: parse, quarantine, JSON validity, judged summaries, replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.judge import parse_judge
from arbiter.operators import ranking as RK
from arbiter.operators import scoring as SC
from arbiter.operators import summaries as SM
from arbiter.plans.catalog import finalize, query
from arbiter.plans.experiment import evaluated
from arbiter.plans.oracle_views import with_views
from arbiter.sources import fixtures as FX

JUDGE_COLS = ["judge_helpfulness", "judge_faithfulness", "judge_conciseness", "judge_safety",
              "judge_reasoning", "judge_avg"]


def parsed(spark, sf_dir):
    return parse_judge(FX.judge_raw(spark, sf_dir))


def judged(spark, sf_dir):
    ok = parsed(spark, sf_dir).where("judge_ok").select(
        "resp_id", "judge_avg", "judge_helpfulness", "judge_faithfulness", "judge_conciseness",
        "judge_safety")
    return evaluated(spark, sf_dir).join(ok, "resp_id", "left")


def summary_judge(spark, sf_dir):
    return SM.experiment_summary(judged(spark, sf_dir), with_judge=True)


@query("judge_parse", with_views("""
    SELECT resp_id, judge_helpfulness, judge_faithfulness, judge_conciseness, judge_safety,
           judge_reasoning, judge_avg FROM judge_parsed WHERE judge_ok""", "judge_parsed"))
def q_judge_parse(spark, sf_dir):
    return finalize(parsed(spark, sf_dir).where("judge_ok").select("resp_id", *JUDGE_COLS))


@query("judge_quarantine", with_views("""
    SELECT resp_id, template, judge_raw FROM judge_parsed WHERE NOT judge_ok AND judge_raw IS NOT NULL""", "judge_parsed"))
def q_judge_quarantine(spark, sf_dir):
    return parsed(spark, sf_dir).where(~F.col("judge_ok") & F.col("judge_raw").isNotNull()).select(
        "resp_id", "template", "judge_raw")


@query("scorer_is_json", with_views("""
    SELECT resp_id, coalesce(json_valid(judge_raw), false) AS raw_is_json FROM judge_raw""", "judge_raw"))
def q_scorer_is_json(spark, sf_dir):
    from arbiter.functions.json_fns import is_json
    return FX.judge_raw(spark, sf_dir).select("resp_id", F.coalesce(is_json("judge_raw"), F.lit(False)).alias("raw_is_json"))


SUMJ_COLS = ["template", "ord", "n_cases", "n_judged", "rule_pass_rate", "avg_rule_score",
             "avg_judge_score", "avg_judge_helpfulness", "avg_judge_faithfulness",
             "avg_judge_conciseness", "avg_judge_safety", "composite"]
SUMJ_SQL = ("template, ord, n_cases, n_judged, round_even(rule_pass_rate, 6) AS rule_pass_rate, "
            "round_even(avg_rule_score, 6) AS avg_rule_score, round_even(avg_judge_score, 6) AS avg_judge_score, "
            "round_even(avg_judge_helpfulness, 6) AS avg_judge_helpfulness, "
            "round_even(avg_judge_faithfulness, 6) AS avg_judge_faithfulness, "
            "round_even(avg_judge_conciseness, 6) AS avg_judge_conciseness, "
            "round_even(avg_judge_safety, 6) AS avg_judge_safety, round_even(composite, 6) AS composite")


@query("experiment_summary_judge", with_views(f"SELECT {SUMJ_SQL} FROM summary_judge",
                                              "summary_judge"))
def q_experiment_summary_judge(spark, sf_dir):
    return finalize(summary_judge(spark, sf_dir).select(*SUMJ_COLS))


@query("best_candidate_judge", with_views(f"""
    SELECT {SUMJ_SQL} FROM (SELECT * FROM summary_judge ORDER BY composite DESC, ord ASC LIMIT 1) t
    WHERE composite >= {D.SCORE_THRESHOLD}""", "summary_judge"))
def q_best_candidate_judge(spark, sf_dir):
    return finalize(RK.best_candidate(summary_judge(spark, sf_dir), D.SCORE_THRESHOLD)
                    .select(*SUMJ_COLS))


@query("batch_judge", with_views("""
    SELECT e.resp_id, e.case_id, j.judge_raw, j.judge_raw IS NULL AS missing_response,
           length('USER MESSAGE:' || chr(10) || e.user_message || chr(10) || chr(10)
                  || 'ASSISTANT RESPONSE:' || chr(10) || e.response) AS prompt_chars
    FROM evaluated e LEFT JOIN judge_raw j ON j.resp_id = e.resp_id""", "evaluated", "judge_raw"))
def q_batch_judge(spark, sf_dir):
    from arbiter.functions.judge import judge_prompt
    from arbiter.operators.evaluate import attach_cases
    ev = attach_cases(FX.responses(spark, sf_dir), FX.golden_cases(spark)).select(
        "resp_id", "case_id", "user_message", "response")
    req = ev.select("resp_id", "case_id",  # the join carries the prompt's length, not its text
                    F.length(judge_prompt("user_message", "response")).cast("bigint").alias("prompt_chars"))
    recorded = FX.judge_raw(spark, sf_dir).select("resp_id", F.col("judge_raw").alias("reply"))
    out = SC.replay(req, recorded, "resp_id")
    return out.select("resp_id", "case_id", F.col("reply").alias("judge_raw"),
                      "missing_response", "prompt_chars")
