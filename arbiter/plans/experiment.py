"""Phase-1/2 queries: rule evaluation, summaries, ranking, gates, naming."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions import hashing as H
from arbiter.functions.rules import composite, exact_mean, token_cost
from arbiter.functions.text import approx_tokens, preview, signed_fixed, snippet, text_clean
from arbiter.operators import evaluate as EV
from arbiter.operators import ranking as RK
from arbiter.operators import summaries as SM
from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import with_views
from arbiter.sources import fixtures as FX

RULE_ONLY_THRESHOLD = 0.50            # rule-only composites of this corpus
GATE_PASS_RATE = 0.40                 # gate thresholds used on this corpus
GATE_LATENCY = 8000.0


def evaluated(spark: SparkSession, sf_dir: str, with_cost: bool = False):
    return EV.evaluate_responses(FX.responses(spark, sf_dir), FX.golden_cases(spark),
                                 cta_phrase=FX.CORPUS_CTA, with_cost=with_cost)


def summary(spark: SparkSession, sf_dir: str):
    return SM.experiment_summary(evaluated(spark, sf_dir))


SUMMARY_COLS = ["template", "ord", "n_cases", "rule_pass_rate", "avg_rule_score",
                "avg_latency_ms", "avg_input_tokens", "avg_output_tokens",
                "avg_judge_score", "composite"]
SUMMARY_SQL_COLS = ("template, ord, n_cases, round_even(rule_pass_rate, 6) AS rule_pass_rate, "
                    "round_even(avg_rule_score, 6) AS avg_rule_score, "
                    "round_even(avg_latency_ms, 6) AS avg_latency_ms, "
                    "round_even(avg_input_tokens, 6) AS avg_input_tokens, "
                    "round_even(avg_output_tokens, 6) AS avg_output_tokens, "
                    "round_even(avg_judge_score, 6) AS avg_judge_score, "
                    "round_even(composite, 6) AS composite")


@query("best_candidate", with_views(f"""
    SELECT {SUMMARY_SQL_COLS} FROM (
      SELECT * FROM summary ORDER BY composite DESC, ord ASC LIMIT 1) t
    WHERE composite >= {RULE_ONLY_THRESHOLD}""", "summary"))
def q_best_candidate(spark, sf_dir):
    return finalize(RK.best_candidate(summary(spark, sf_dir), RULE_ONLY_THRESHOLD)
                    .select(*SUMMARY_COLS))


@query("experiment_summary", with_views(f"SELECT {SUMMARY_SQL_COLS} FROM summary", "summary"))
def q_experiment_summary(spark, sf_dir):
    return finalize(summary(spark, sf_dir).select(*SUMMARY_COLS))


@query("leaderboard", with_views(
    "SELECT template, ord, round_even(rule_pass_rate, 6) AS rule_pass_rate, "
    "round_even(avg_rule_score, 6) AS avg_rule_score, "
    "CASE WHEN avg_judge_score <> 0 THEN printf('%5.2f', avg_judge_score) ELSE '  N/A' END AS judge_str, "
    "round_even(avg_latency_ms, 6) AS avg_latency_ms FROM summary ORDER BY ord", "summary"))
def q_leaderboard(spark, sf_dir):
    s = RK.leaderboard(summary(spark, sf_dir))
    judge = F.when(F.col("avg_judge_score") != 0,
                   F.format_string("%5.2f", "avg_judge_score")).otherwise(F.lit("  N/A"))
    return finalize(s.select("template", "ord", "rule_pass_rate", "avg_rule_score",
                             judge.alias("judge_str"), "avg_latency_ms"))


@query("summary_union", with_views("""
    SELECT template, CAST(count(*) AS BIGINT) AS n_cases, round_even((CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)), 6) AS avg_rule_score
    FROM evaluated GROUP BY template""", "evaluated"))
def q_summary_union(spark, sf_dir):
    # the bag union of separate per-template summaries is one groupBy
    return finalize(evaluated(spark, sf_dir).groupBy("template").agg(
        F.count(F.lit(1)).alias("n_cases"), exact_mean("score", 3).alias("avg_rule_score")))


RULE_ROW_SQL = "resp_id, template, case_id"


@query("response_case_join", with_views(f"""
    SELECT r.resp_id, r.template, r.case_id, c.user_message, CAST(c.max_words AS INTEGER) AS max_words,
           CAST(len(c.expected_topics) AS BIGINT) AS n_topics
    FROM responses r JOIN cases c USING (case_id)""", "responses", "cases"))
def q_response_case_join(spark, sf_dir):
    j = EV.attach_cases(FX.responses(spark, sf_dir), FX.golden_cases(spark))
    return j.select("resp_id", "template", "case_id", "user_message", "max_words",
                    F.size("expected_topics").cast("bigint").alias("n_topics"))


@query("topic_hits", with_views(f"""
    SELECT {RULE_ROW_SQL}, topic_hits, array_to_string(topic_misses, ',') AS topic_misses
    FROM evaluated""", "evaluated"))
def q_topic_hits(spark, sf_dir):
    return evaluated(spark, sf_dir).select(
        "resp_id", "template", "case_id", "topic_hits",
        F.array_join("topic_misses", ",").alias("topic_misses"))


@query("violations", with_views(f"""
    SELECT {RULE_ROW_SQL}, array_to_string(must_not_violated, ',') AS violations,
           CAST(len(must_not_violated) AS BIGINT) AS n_violations
    FROM evaluated""", "evaluated"))
def q_violations(spark, sf_dir):
    return evaluated(spark, sf_dir).select(
        "resp_id", "template", "case_id",
        F.array_join("must_not_violated", ",").alias("violations"),
        F.size("must_not_violated").cast("bigint").alias("n_violations"))


@query("word_count_limit", with_views(f"""
    SELECT {RULE_ROW_SQL}, word_count, within_word_limit FROM evaluated""", "evaluated"))
def q_word_count_limit(spark, sf_dir):
    return evaluated(spark, sf_dir).select("resp_id", "template", "case_id", "word_count",
                                           "within_word_limit")


@query("cta_flag", with_views(f"""
    SELECT {RULE_ROW_SQL}, ends_with_cta FROM evaluated""", "evaluated"))
def q_cta_flag(spark, sf_dir):
    return evaluated(spark, sf_dir).select("resp_id", "template", "case_id", "ends_with_cta")


@query("rule_score", with_views(f"""
    SELECT {RULE_ROW_SQL}, score, passed FROM evaluated""", "evaluated"))
def q_rule_score(spark, sf_dir):
    return finalize(evaluated(spark, sf_dir).select("resp_id", "template", "case_id", "score",
                                                    "passed"))


@query("token_cost", with_views("""
    SELECT resp_id, input_tokens, output_tokens, cost_usd FROM evaluated""", "evaluated"))
def q_token_cost(spark, sf_dir):
    r = FX.responses(spark, sf_dir)
    return finalize(r.select("resp_id", "input_tokens", "output_tokens",
                             token_cost("input_tokens", "output_tokens").alias("cost_usd")))


@query("approx_tokens", with_views("""
    SELECT resp_id, output_tokens AS approx_tokens FROM responses""", "responses"))
def q_approx_tokens(spark, sf_dir):
    from arbiter.functions.text import word_count
    d = FX.responses(spark, sf_dir)
    return d.select("resp_id", approx_tokens(word_count("response")).alias("approx_tokens"))


CI_SUMMARY_SQL = """
    SELECT template, CAST(count(*) AS BIGINT) AS n_cases,
           avg(CAST(passed AS INTEGER)) AS rule_pass_rate, (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS avg_rule_score,
           (CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / CAST(10 * count(latency_ms) AS DOUBLE)) AS avg_latency_ms, (CAST(sum(CAST(round(cost_usd * 1000000) AS BIGINT)) AS DOUBLE) / CAST(1000000 * count(cost_usd) AS DOUBLE)) AS avg_cost_usd,
           CAST(sum(input_tokens) AS BIGINT) AS total_in_tokens,
           CAST(sum(output_tokens) AS BIGINT) AS total_out_tokens
    FROM evaluated GROUP BY template"""


def ci(spark, sf_dir):
    return SM.ci_summary(evaluated(spark, sf_dir, with_cost=True))


@query("ci_summary", with_views(f"""
    SELECT template, n_cases, round_even(rule_pass_rate, 6) AS rule_pass_rate,
           round_even(avg_rule_score, 6) AS avg_rule_score, round_even(avg_latency_ms, 6) AS avg_latency_ms,
           round_even(avg_cost_usd, 6) AS avg_cost_usd, total_in_tokens, total_out_tokens
    FROM ({CI_SUMMARY_SQL}) s""", "evaluated"))
def q_ci_summary(spark, sf_dir):
    return finalize(ci(spark, sf_dir))


def gates(spark):
    return SM.gate_table(spark, GATE_PASS_RATE, GATE_LATENCY, D.GATE_AVG_COST_USD)


GATES_SQL = f"""
    SELECT * FROM (VALUES ('rule_pass_rate', 'rule_pass_rate', '>=', CAST({GATE_PASS_RATE} AS DOUBLE), 0),
                          ('avg_latency_ms', 'avg_latency_ms', '<=', CAST({GATE_LATENCY} AS DOUBLE), 1),
                          ('avg_cost_usd', 'avg_cost_usd', '<=', CAST({D.GATE_AVG_COST_USD} AS DOUBLE), 2))
    AS g(gate, metric, direction, threshold, gate_ord)"""

VERDICTS_SQL = f"""
    verdicts AS (
      SELECT s.template, g.gate, g.gate_ord, g.direction, g.threshold, m.actual,
             CASE WHEN g.direction = '>=' THEN m.actual >= g.threshold ELSE m.actual <= g.threshold END AS passed
      FROM ({CI_SUMMARY_SQL}) s
      CROSS JOIN LATERAL (VALUES ('rule_pass_rate', s.rule_pass_rate), ('avg_latency_ms', s.avg_latency_ms),
                                 ('avg_cost_usd', s.avg_cost_usd)) AS m(metric, actual)
      JOIN ({GATES_SQL}) g ON g.metric = m.metric)"""


@query("quality_gates", with_views(f""", {VERDICTS_SQL.strip()}
    SELECT template, bool_and(passed) AS all_passed,
           CAST(count_if(passed) AS BIGINT) AS n_gates_passed, CAST(count(*) AS BIGINT) AS n_gates_total,
           coalesce(string_agg(CASE WHEN NOT passed THEN gate END, ',' ORDER BY gate_ord), '') AS gates_failed,
           max(CASE WHEN gate = 'rule_pass_rate' THEN CAST(passed AS INTEGER) END) AS gate_rule_pass_rate,
           max(CASE WHEN gate = 'avg_latency_ms' THEN CAST(passed AS INTEGER) END) AS gate_avg_latency_ms,
           max(CASE WHEN gate = 'avg_cost_usd' THEN CAST(passed AS INTEGER) END) AS gate_avg_cost_usd
    FROM verdicts GROUP BY template""", "evaluated").replace("\n, verdicts", ",\nverdicts", 1))
def q_quality_gates(spark, sf_dir):
    v = SM.gate_verdicts(ci(spark, sf_dir), gates(spark))
    return SM.gate_rollup(v)


@query("composite_score", with_views("""
    SELECT template, round_even(avg_rule_score, 6) AS avg_rule_score,
           round_even(avg_judge_score, 6) AS avg_judge_score, round_even(composite, 6) AS composite
    FROM summary_judge""", "summary_judge"))
def q_composite_score(spark, sf_dir):
    # rule mean and parsed-judge mean per template; templates without judged
    # rows carry the 0.0 sentinel and fall back to the rule score
    from arbiter.plans.judge_plans import judged
    s = judged(spark, sf_dir).groupBy("template").agg(
        exact_mean("score", 3).alias("avg_rule_score"),
        F.coalesce(exact_mean("judge_avg", 2), F.lit(0.0)).alias("avg_judge_score"))
    return finalize(s.select("template", "avg_rule_score", "avg_judge_score",
                             composite("avg_rule_score", "avg_judge_score").alias("composite")))


@query("case_sample", """
    SELECT template, resp_id FROM (
      SELECT source AS template, doc_id AS resp_id,
             row_number() OVER (PARTITION BY source ORDER BY md5('s' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
      FROM documents) t WHERE rn <= 2""")
def q_case_sample(spark, sf_dir):
    r = FX.responses(spark, sf_dir).select("template", "resp_id")
    return RK.seeded_sample(r, "resp_id", 2, seed="s", partition_cols=["template"])


@query("experiment_grid", with_views("""
    SELECT t.template, t.ord, c.case_id, c.max_words
    FROM (SELECT DISTINCT source AS template, CAST(substr(source, 4) AS INTEGER) AS ord FROM documents) t
    CROSS JOIN cases c""", "cases"))
def q_experiment_grid(spark, sf_dir):
    t = FX.responses(spark, sf_dir).select("template", "ord").distinct()
    g = EV.experiment_grid(t, FX.golden_cases(spark))
    return g.select("template", "ord", "case_id", "max_words")


@query("display_projection", with_views("""
    SELECT resp_id, substr(response, 1, 120) AS reply_snippet,
           replace(substr(response, 1, 80), chr(10), ' ') AS reply_preview,
           substr(user_message, 1, 60) AS message_preview,
           printf('%.0f%%', rule_pass_rate_pct) AS pass_pct
    FROM (SELECT e.*, CASE WHEN passed THEN 100.0 ELSE 0.0 END AS rule_pass_rate_pct FROM evaluated e) t""",
    "evaluated"))
def q_display_projection(spark, sf_dir):
    e = evaluated(spark, sf_dir)
    pct = F.when(F.col("passed"), F.lit(100.0)).otherwise(F.lit(0.0))
    return e.select("resp_id", snippet("response").alias("reply_snippet"),
                    preview("response").alias("reply_preview"),
                    F.substring("user_message", 1, D.PREVIEW_CHARS).alias("message_preview"),
                    F.format_string("%.0f%%", pct).alias("pass_pct"))


@query("reason_text", with_views(f""", {VERDICTS_SQL.strip()}
    SELECT template,
           'delta=' || printf('%+.4f', actual - threshold) || ' did not exceed min_improvement=0.02' AS reason,
           'gates_failed:' || gate AS failed
    FROM verdicts WHERE gate = 'rule_pass_rate'""", "evaluated").replace("\n, verdicts", ",\nverdicts", 1))
def q_reason_text(spark, sf_dir):
    v = SM.gate_verdicts(ci(spark, sf_dir), gates(spark)).where(F.col("gate") == "rule_pass_rate")
    return v.select("template",
                    F.concat(F.lit("delta="), signed_fixed(F.col("actual") - F.col("threshold")),
                             F.lit(f" did not exceed min_improvement={D.CC_MIN_IMPROVEMENT}")).alias("reason"),
                    F.concat(F.lit("gates_failed:"), F.col("gate")).alias("failed"))


@query("text_clean", """
    SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS clean_text
    FROM documents""")
def q_text_clean(spark, sf_dir):
    from arbiter.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", text_clean("text").alias("clean_text"))


# template rows of the corpus with their canonical config and hash
TEMPLATE_SQL = f"""
    SELECT DISTINCT source AS name, '1.0.' || substr(source, 4) AS version,
           'You are support agent ' || source AS system, 'model-' || CAST(CAST(substr(source, 4) AS INTEGER) % 3 AS VARCHAR) AS model,
           CAST(substr(source, 4) AS INTEGER) AS ord FROM documents"""


@query("config_hash", f"""
    SELECT name, substr(sha256(canon), 1, 12) AS config_hash FROM (
      SELECT name, '{{"few_shots": [], "max_tokens": 1024, "model": "' || model || '", "name": "' || name
             || '", "system": "' || system || '", "temperature": 0.3, "version": "' || version || '"}}' AS canon
      FROM ({TEMPLATE_SQL}) t) c""")
def q_config_hash(spark, sf_dir):
    t = H.corpus_templates(spark, sf_dir)
    return t.select("name", H.config_hash(t).alias("config_hash"))


@query("run_name", f"""
    SELECT name, name || '-v' || version || '-' || substr(sha256(canon), 1, 12) AS experiment_run,
           'ci-' || substr(sha, 1, 8) || '-' || CASE WHEN ord % 2 = 0 THEN 'pass' ELSE 'fail' END AS ci_run,
           'cd-staging-' || substr(sha, 1, 8) || '-' || CASE WHEN ord % 3 = 0 THEN 'pass' ELSE 'fail' END AS cd_run,
           'cc-' || CASE WHEN ord % 4 = 0 THEN 'promoted' ELSE 'retained' END || '-' || substr(sha, 1, 8) AS cc_run
    FROM (SELECT t.*, md5(name) AS sha,
            '{{"few_shots": [], "max_tokens": 1024, "model": "' || model || '", "name": "' || name
             || '", "system": "' || system || '", "temperature": 0.3, "version": "' || version || '"}}' AS canon
          FROM ({TEMPLATE_SQL}) t) c""")
def q_run_name(spark, sf_dir):
    t = H.corpus_templates(spark, sf_dir)
    sha = F.md5("name")
    o = F.col("ord")
    return t.select(
        "name",
        H.experiment_run_name("name", "version", H.config_hash(t)).alias("experiment_run"),
        H.ci_run_name(sha, o % 2 == 0).alias("ci_run"),
        H.cd_staging_run_name(sha, o % 3 == 0).alias("cd_run"),
        H.cc_run_name(sha, o % 4 == 0).alias("cc_run"))


@query("summary_template_lookup", with_views(f"""
    SELECT s.template, t.version, t.model, substr(sha256(
        '{{"few_shots": [], "max_tokens": 1024, "model": "' || t.model || '", "name": "' || t.name
        || '", "system": "' || t.system || '", "temperature": 0.3, "version": "' || t.version || '"}}'), 1, 12) AS config_hash
    FROM summary s JOIN ({TEMPLATE_SQL}) t ON t.name = s.template""", "summary"))
def q_summary_template_lookup(spark, sf_dir):
    # every name has two configs; the summary carries the hash of the one that ran
    t = H.corpus_templates(spark, sf_dir)
    t = t.unionByName(t.withColumn("version", F.concat(F.lit("2."), "version")).withColumn("temperature", F.lit(0.9)))
    t = t.select("name", "version", "model", H.config_hash(t).alias("config_hash"))
    ran = H.template_rows(summary(spark, sf_dir).select(F.col("template").alias("source")))
    s = ran.select(F.col("name").alias("template"), H.config_hash(ran).alias("config_hash"))
    return s.join(t.withColumnRenamed("name", "template"), ["template", "config_hash"]).select(
        "template", "version", "model", "config_hash")
