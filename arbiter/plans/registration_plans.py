"""Registration, CI and staging writes, and the gate that reads them."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter.operators import ranking as RK
from arbiter.operators import registration as RG
from arbiter.operators import registry as R
from arbiter.operators import summaries as SM
from arbiter.plans.catalog import query
from arbiter.plans.experiment import VERDICTS_SQL, ci, gates, summary
from arbiter.plans.lifecycle import reg, state
from arbiter.plans.oracle_views import register_view, with_views
from arbiter.plans.scorer_plans import probe_checks

THRESHOLD = 0.5   # rule-only composites of the corpus stay below 0.6

register_view("verdict_rows", ("evaluated",), f"WITH {VERDICTS_SQL.strip()} SELECT * FROM verdicts")
# one model per remainder of the template number, ids among those of the log
register_view("best_of_model", ("summary",), f"""
    SELECT model, template, composite, 'run-' || template AS run_id FROM (
      SELECT *, CAST(1 + ord % 3 AS VARCHAR) AS model,
             row_number() OVER (PARTITION BY ord % 3 ORDER BY composite DESC, ord) AS rk FROM summary) s
    WHERE rk = 1 AND composite >= {THRESHOLD}""")
register_view("new_candidates", ("best_of_model", "registry"), """
    SELECT b.*, CAST(coalesce((SELECT max(CAST(version AS BIGINT)) FROM registry r
                               WHERE r.model = b.model AND r.kind = 'register'), 0) + 1 AS VARCHAR) AS version
    FROM best_of_model b""")
register_view("new_ci", ("new_candidates", "verdict_rows"), """
    SELECT c.*, coalesce((SELECT bool_and(passed) FROM verdict_rows v WHERE v.template = c.template), false) AS ok
    FROM new_candidates c""")
register_view("new_staging", ("new_candidates", "probe_checks"), """
    SELECT c.*, coalesce((SELECT bool_and(passed) FROM probe_checks p WHERE p.template = c.template), false) AS ok
    FROM new_candidates c""")


def best(spark, sf_dir):
    s = summary(spark, sf_dir).withColumn("model", (1 + F.col("ord") % 3).cast("string"))
    return RK.best_candidate(s, THRESHOLD, ["model"]).select(
        "model", "template", F.concat(F.lit("run-"), "template").alias("run_id"))


def registration(spark, sf_dir):
    return RG.candidate_events(best(spark, sf_dir), reg(spark, sf_dir))


def candidates(spark, sf_dir):
    """model, template, version, run_id of the newly registered versions."""
    tags = registration(spark, sf_dir).where(F.col("tag_key") == "template_name")
    return tags.select("model", F.col("tag_value").alias("template"), "version", "run_id")


@query("best_candidate_per_model", with_views("SELECT model, template, run_id FROM best_of_model", "best_of_model"))
def q_best_candidate_per_model(spark, sf_dir):
    return best(spark, sf_dir)


@query("candidate_events", with_views("""
    SELECT model, CAST(e.ev_ord AS INTEGER) AS ev_ord, e.kind, version, run_id, e.alias, e.tag_key,
           CASE WHEN e.tag_key IS NOT NULL THEN template END AS tag_value
    FROM new_candidates, (VALUES (0, 'register', NULL, NULL), (1, 'set_alias', 'candidate', NULL),
                                 (2, 'set_tag', NULL, 'template_name')) e(ev_ord, kind, alias, tag_key)""",
    "new_candidates"))
def q_candidate_events(spark, sf_dir):
    return registration(spark, sf_dir)


@query("ci_events", with_views("""
    SELECT model, CAST(e.ev_ord AS INTEGER) AS ev_ord, 'set_tag' AS kind, version, run_id, CAST(NULL AS VARCHAR) AS alias,
           e.tag_key, CASE WHEN e.ev_ord = 1 THEN 'ci-' || substr(md5(template), 1, 8) || '-' ELSE '' END
                      || CASE WHEN ok THEN 'pass' ELSE 'fail' END AS tag_value
    FROM new_ci, (VALUES (0, 'ci_last_result'), (1, 'ci_last_run_id')) e(ev_ord, tag_key)""", "new_ci"))
def q_ci_events(spark, sf_dir):
    g = SM.gate_rollup(SM.gate_verdicts(ci(spark, sf_dir), gates(spark)))
    return RG.ci_events(candidates(spark, sf_dir), g)


@query("staging_events", with_views("""
    SELECT model, CAST(0 AS INTEGER) AS ev_ord, 'set_tag' AS kind, version, run_id, CAST(NULL AS VARCHAR) AS alias,
           'cd_staging' AS tag_key, CASE WHEN ok THEN 'pass' ELSE 'fail' END AS tag_value
    FROM new_staging""", "new_staging"))
def q_staging_events(spark, sf_dir):
    return RG.staging_events(candidates(spark, sf_dir), SM.smoke_summary(probe_checks(spark, sf_dir)))


@query("staging_gate_after_events", with_views("""
    SELECT model, version, ok AS staging_ok FROM new_staging""", "new_staging"))
def q_staging_gate_after_events(spark, sf_dir):
    # the three phases write events; folded into the state of the log before
    # them, the gate reads the tag they wrote
    writes = [q_candidate_events(spark, sf_dir), q_ci_events(spark, sf_dir), q_staging_events(spark, sf_dir)]
    after = R.fold_log(RG.number_writes(reg(spark, sf_dir), *writes), state(spark, sf_dir))
    new = candidates(spark, sf_dir).select("model", "version")
    held = after.aliases.where(F.col("alias") == "candidate").select("model", "version").join(
        new, ["model", "version"], "left_semi")
    return R.staging_gate(held, after.tags).select("model", "version", "staging_ok")
