"""Registry state, version resolution, champion/challenger and deployment."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions import hashing as H
from arbiter.functions.rules import exact_mean
from arbiter.operators import compare as CP
from arbiter.operators import registry as R
from arbiter.operators.common import bounded_broadcast
from arbiter.functions.rounding import exact_round_sql as XR
from arbiter.plans.catalog import finalize, query
from arbiter.plans.experiment import TEMPLATE_SQL, evaluated
from arbiter.plans.oracle_views import register_view, with_views
from arbiter.sources import fixtures as FX

EVALUATED_AT = "2024-06-01T00:00:00+00:00"     # fixed run parameters of the corpus
DEPLOYED_AT = "2024-06-02T00:00:00+00:00"
APPROVER = "release-bot"


def reg(spark, sf_dir):
    return FX.registry_events(spark, sf_dir)


def state(spark, sf_dir):
    return FX.registry_state(spark, sf_dir)


def lineage(spark, sf_dir):
    """registered version -> run -> config artifact (template chosen by the run)."""
    return state(spark, sf_dir).versions.select(
        "model", "version", "run_id",
        F.concat(F.lit("src"), (F.col("reg_seq") % 20).cast("string")).alias("template"))


def override():
    """Every tenth model is pinned to its first version."""
    return F.when(F.col("model").cast("bigint") % 10 == 0, F.lit("1")).otherwise(F.lit(""))


def requests(spark, sf_dir):
    m = state(spark, sf_dir).versions.select("model").distinct()
    return m.select("model", override().alias("override"),
                    F.lit("champion").alias("alias"), F.lit("production").alias("fallback_alias"))


def resolved(spark, sf_dir):
    return R.resolve_versions(requests(spark, sf_dir), state(spark, sf_dir).aliases)


def pairs(spark, sf_dir):
    """champion (explicit -> champion -> production) and challenger
    (candidate) per model from one pivoted alias row (a model without a
    candidate makes no pair, so the row has every model that counts)."""
    row = R.alias_row(state(spark, sf_dir).aliases).withColumn("override", override())
    r = R.resolve_row(row, "champion", "production")
    return r.where(F.col("version").isNotNull() & F.col("candidate").isNotNull()).select(
        "model", F.col("version").alias("champ_version"), F.col("resolved_via").alias("champ_via"),
        F.col("candidate").alias("chall_version"))


def compared_pairs(spark, sf_dir):
    """Pairs with distinct versions, each side mapped to its template: the
    two sides go through one join with the lineage and are pivoted back."""
    p = pairs(spark, sf_dir).where(F.col("champ_version") != F.col("chall_version"))
    cols = p.columns
    sides = p.select(*cols, F.explode(F.array(
        F.struct(F.lit("champ").alias("side"), F.col("champ_version").alias("v")),
        F.struct(F.lit("chall").alias("side"), F.col("chall_version").alias("v")))).alias("s")
    ).select(*cols, "s.side", F.col("s.v").alias("version"))
    lin = lineage(spark, sf_dir).select("model", "version", "template")
    t = sides.join(lin, ["model", "version"]).groupBy(*cols).agg(
        F.max(F.when(F.col("side") == "champ", F.col("template"))).alias("champ_template"),
        F.max(F.when(F.col("side") == "chall", F.col("template"))).alias("chall_template"))
    return t.where(F.col("champ_template").isNotNull() & F.col("chall_template").isNotNull())


def side_results(spark, sf_dir):
    ev = evaluated(spark, sf_dir, with_cost=True)
    from arbiter.plans.judge_plans import parsed
    ok = parsed(spark, sf_dir).where("judge_ok").select("resp_id", "judge_avg")
    return CP.side_summary(ev.join(ok, "resp_id", "left"))


def decisions(spark, sf_dir):
    sides = CP.attach_sides(compared_pairs(spark, sf_dir), side_results(spark, sf_dir))
    return CP.promotion_decision(sides)


# ---- oracle views for the lifecycle ------------------------------------------------
register_view("lineage", ("registry",), """
    SELECT model, version, run_id, 'src' || CAST(seq % 20 AS VARCHAR) AS template
    FROM registry WHERE kind = 'register'""")
register_view("resolved", ("registry", "alias_state"), """
    SELECT q.model, q.override, q.alias, q.fallback_alias,
           coalesce(nullif(q.override, ''), a.version, f.version) AS version,
           CASE WHEN nullif(q.override, '') IS NOT NULL THEN 'explicit:' || q.override
                WHEN a.version IS NOT NULL THEN q.alias
                WHEN f.version IS NOT NULL THEN q.fallback_alias END AS resolved_via
    FROM (SELECT DISTINCT model,
                 CASE WHEN CAST(model AS BIGINT) % 10 = 0 THEN '1' ELSE '' END AS override,
                 'champion' AS alias, 'production' AS fallback_alias FROM registry) q
    LEFT JOIN alias_state a ON a.model = q.model AND a.alias = q.alias
    LEFT JOIN alias_state f ON f.model = q.model AND f.alias = q.fallback_alias""")
register_view("pairs", ("resolved", "alias_state"), """
    SELECT c.model, c.version AS champ_version, c.resolved_via AS champ_via, k.version AS chall_version
    FROM resolved c JOIN alias_state k ON k.model = c.model AND k.alias = 'candidate'
    WHERE c.version IS NOT NULL""")
register_view("compared", ("pairs", "lineage"), """
    SELECT p.*, lc.template AS champ_template, lk.template AS chall_template
    FROM pairs p JOIN lineage lc ON lc.model = p.model AND lc.version = p.champ_version
                 JOIN lineage lk ON lk.model = p.model AND lk.version = p.chall_version
    WHERE p.champ_version <> p.chall_version""")
register_view("sides", ("evaluated", "judge_parsed"), f"""
    SELECT template, {XR('pr', 4)} AS rule_pass_rate, {XR('rs', 4)} AS avg_rule_score,
           {XR('js', 4)} AS avg_judge_score, {XR('lat', 1)} AS avg_latency_ms,
           {XR('cost', 6)} AS avg_cost_usd, {XR('(rs * 0.5 + (js / 5.0) * 0.5)', 4)} AS composite
    FROM (SELECT e.template, avg(CAST(e.passed AS INTEGER)) AS pr, (CAST(sum(CAST(round(e.score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(e.score) AS DOUBLE)) AS rs,
                 coalesce((CAST(sum(CAST(round(j.judge_avg * 100) AS BIGINT)) AS DOUBLE) / CAST(100 * count(j.judge_avg) AS DOUBLE)), CAST(0.0 AS DOUBLE)) AS js, (CAST(sum(CAST(round(e.latency_ms * 10) AS BIGINT)) AS DOUBLE) / CAST(10 * count(e.latency_ms) AS DOUBLE)) AS lat,
                 (CAST(sum(CAST(round(e.cost_usd * 1000000) AS BIGINT)) AS DOUBLE) / CAST(1000000 * count(e.cost_usd) AS DOUBLE)) AS cost
          FROM evaluated e LEFT JOIN (SELECT resp_id, judge_avg FROM judge_parsed WHERE judge_ok) j
            ON j.resp_id = e.resp_id GROUP BY e.template) t""")
register_view("decisions", ("compared", "sides"), f"""
    SELECT c.model, c.champ_version, c.chall_version, c.champ_template, c.chall_template,
           sc.composite AS champ_composite, sk.composite AS chall_composite,
           sk.composite - sc.composite AS delta,
           (sk.composite - sc.composite) > CAST({D.CC_MIN_IMPROVEMENT} AS DOUBLE) AS promote,
           sk.avg_latency_ms - sc.avg_latency_ms AS latency_delta,
           sk.avg_cost_usd - sc.avg_cost_usd AS cost_delta,
           'delta=' || printf('%+.4f', sk.composite - sc.composite)
             || ' did not exceed min_improvement={D.CC_MIN_IMPROVEMENT}' AS reason
    FROM compared c JOIN sides sc ON sc.template = c.champ_template
                    JOIN sides sk ON sk.template = c.chall_template""")
register_view("deploy_cands", ("alias_state", "tag_state", "lineage"), f"""
    SELECT a.model, a.version, p.version AS prev_version, substr(md5(a.model), 1, 12) AS git_sha,
           t.name AS template_name, t.version AS template_version, t.model AS llm_model
    FROM alias_state a
    JOIN tag_state s ON s.model = a.model AND s.version = a.version AND s.tag_key = 'cd_staging'
                     AND s.tag_value = 'pass'
    LEFT JOIN alias_state p ON p.model = a.model AND p.alias = 'production'
    JOIN lineage l ON l.model = a.model AND l.version = a.version
    JOIN ({TEMPLATE_SQL}) t ON t.name = l.template
    WHERE a.alias = 'candidate'""")


@query("register_version", with_views("""
    SELECT model, seq, run_id, CAST(row_number() OVER (PARTITION BY model ORDER BY seq) AS VARCHAR) AS version
    FROM registry WHERE kind = 'register'""", "registry"))
def q_register_version(spark, sf_dir):
    return R.register_version(reg(spark, sf_dir).drop("version"))


@query("alias_state", with_views("SELECT model, alias, version, set_seq FROM alias_state",
                                 "alias_state"))
def q_alias_state(spark, sf_dir):
    return state(spark, sf_dir).aliases


@query("tag_state", with_views("SELECT model, version, tag_key, tag_value FROM tag_state",
                               "tag_state"))
def q_tag_state(spark, sf_dir):
    return state(spark, sf_dir).tags.select("model", "version", "tag_key", "tag_value")


@query("latest_version", with_views("""
    SELECT model, CAST(max(CAST(version AS BIGINT)) AS BIGINT) AS latest_version
    FROM registry r WHERE kind = 'register' AND NOT EXISTS (
      SELECT 1 FROM registry d WHERE d.model = r.model AND d.seq > r.seq
        AND (d.kind = 'delete_model' OR d.kind = 'delete_version' AND d.version = r.version))
    GROUP BY model""", "registry"))
def q_latest_version(spark, sf_dir):
    return R.latest_version(state(spark, sf_dir).versions)


@query("previous_alias_version", with_views("""
    , writes AS (
      SELECT s.model, s.alias, s.seq, s.version, v.del_seq FROM registry s LEFT JOIN vdel v USING (model, version)
      WHERE s.kind = 'set_alias' AND (v.del_seq IS NULL OR v.del_seq > s.seq)),
    last AS (
      SELECT w.model, w.alias, w.seq, w.version, max(p.seq) AS held_since
      FROM writes w LEFT JOIN (SELECT model, alias, seq FROM writes
                               UNION ALL SELECT model, alias, seq FROM registry WHERE kind = 'delete_alias') p
        ON p.model = w.model AND p.alias = w.alias AND p.seq < w.seq
      GROUP BY ALL)
    SELECT l.model, l.alias, l.seq, l.version,
           CASE WHEN h.version IS NULL OR h.del_seq < l.seq THEN 'none' ELSE h.version END AS prev_version
    FROM last l LEFT JOIN writes h ON h.model = l.model AND h.alias = l.alias AND h.seq = l.held_since""",
    "registry", "vdel"))
def q_previous_alias_version(spark, sf_dir):
    return R.previous_alias_version(reg(spark, sf_dir), state(spark, sf_dir).versions)


@query("staging_gate", with_views("""
    SELECT a.model, a.version, coalesce(t.tag_value, '') = 'pass' AS staging_ok
    FROM alias_state a LEFT JOIN tag_state t
      ON t.model = a.model AND t.version = a.version AND t.tag_key = 'cd_staging'
    WHERE a.alias = 'candidate'""", "alias_state", "tag_state"))
def q_staging_gate(spark, sf_dir):
    st = state(spark, sf_dir)
    cands = st.aliases.where(F.col("alias") == "candidate").select("model", "version")
    return R.staging_gate(cands, st.tags).select("model", "version", "staging_ok")


@query("approval_gate", with_views("""
    SELECT a.model, a.version, coalesce(lower(t.tag_value), '') = 'pass' AS approved
    FROM alias_state a LEFT JOIN tag_state t
      ON t.model = a.model AND t.version = a.version AND t.tag_key = 'cd_staging'
    WHERE a.alias = 'champion'""", "alias_state", "tag_state"))
def q_approval_gate(spark, sf_dir):
    # approval task named after the staging tag; approved value 'PASS' (case-insensitive)
    st = state(spark, sf_dir)
    cands = st.aliases.where(F.col("alias") == "champion").select("model", "version")
    return R.approval_gate(cands, st.tags, "cd_staging", "PASS").select(
        "model", "version", "approved")


@query("alias_fallback_join", with_views("SELECT model, version, resolved_via FROM resolved",
                                         "resolved"))
def q_alias_fallback_join(spark, sf_dir):
    return resolved(spark, sf_dir).select("model", "version", "resolved_via")


@query("registry_lineage_join", with_views(f"""
    SELECT a.model, a.version, l.run_id, l.template AS template_name, t.version AS template_version,
           t.model AS llm_model
    FROM alias_state a JOIN lineage l ON l.model = a.model AND l.version = a.version
    JOIN ({TEMPLATE_SQL}) t ON t.name = l.template
    WHERE a.alias = 'candidate'""", "alias_state", "lineage"))
def q_registry_lineage_join(spark, sf_dir):
    a = state(spark, sf_dir).aliases.where(F.col("alias") == "candidate").select("model", "version")
    t = H.corpus_templates(spark, sf_dir).select(
        F.col("name").alias("template"), F.col("version").alias("template_version"),
        F.col("model").alias("llm_model"))
    j = a.join(lineage(spark, sf_dir), ["model", "version"]).join(bounded_broadcast(t), "template")
    return j.select("model", "version", "run_id", F.col("template").alias("template_name"),
                    "template_version", "llm_model")


@query("same_version_guard", with_views("""
    SELECT model, champ_version AS version, champ_via FROM pairs WHERE champ_version = chall_version""",
    "pairs"))
def q_same_version_guard(spark, sf_dir):
    # pairs whose champion and challenger resolve to one version are skipped
    p = pairs(spark, sf_dir)
    return p.where(F.col("champ_version") == F.col("chall_version")).select(
        "model", F.col("champ_version").alias("version"), "champ_via")


@query("paired_compare", with_views("""
    SELECT c.model, x.case_id, round_even(x.avg_score, 6) AS champ_avg_score,
           round_even(y.avg_score, 6) AS chall_avg_score, round_even(y.avg_score - x.avg_score, 6) + 0.0 AS delta_score
    FROM compared c
    JOIN (SELECT template, case_id, (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS avg_score FROM evaluated GROUP BY template, case_id) x
      ON x.template = c.champ_template
    JOIN (SELECT template, case_id, (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS avg_score FROM evaluated GROUP BY template, case_id) y
      ON y.template = c.chall_template AND y.case_id = x.case_id""", "compared", "evaluated"))
def q_paired_compare(spark, sf_dir):
    per_case = evaluated(spark, sf_dir).groupBy("template", "case_id").agg(
        exact_mean("score", 3).alias("avg_score"))
    pc = bounded_broadcast(per_case)
    p = compared_pairs(spark, sf_dir).select("model", "champ_template", "chall_template")
    sides = p.select("model", F.explode(F.array(
        F.struct(F.lit("champ").alias("side"), F.col("champ_template").alias("template")),
        F.struct(F.lit("chall").alias("side"), F.col("chall_template").alias("template")))).alias("s")
    ).select("model", "s.side", "s.template")
    j = sides.join(pc, "template").groupBy("model", "case_id").agg(
        F.max(F.when(F.col("side") == "champ", F.col("avg_score"))).alias("champ_avg_score"),
        F.max(F.when(F.col("side") == "chall", F.col("avg_score"))).alias("chall_avg_score"))
    j = j.where(F.col("champ_avg_score").isNotNull() & F.col("chall_avg_score").isNotNull())
    return finalize(j.select("model", "case_id", "champ_avg_score", "chall_avg_score",
                             (F.col("chall_avg_score") - F.col("champ_avg_score")).alias("delta_score")))


DECISION_COLS = ["model", "champ_version", "chall_version", "champ_template", "chall_template",
                 "champ_composite", "chall_composite", "delta", "promote", "latency_delta",
                 "cost_delta", "reason"]


@query("promotion_decision", with_views("""
    SELECT model, champ_version, chall_version, champ_template, chall_template,
           round_even(champ_composite, 6) AS champ_composite, round_even(chall_composite, 6) AS chall_composite,
           round_even(delta, 6) + 0.0 AS delta, promote, round_even(latency_delta, 6) + 0.0 AS latency_delta,
           round_even(cost_delta, 6) + 0.0 AS cost_delta, reason FROM decisions""", "decisions"))
def q_promotion_decision(spark, sf_dir):
    return finalize(decisions(spark, sf_dir).select(*DECISION_COLS))


PYSTR4 = "regexp_replace(regexp_replace(printf('%.4f', " + XR("{0}", 4) + "), '0+$', ''), '\\.$', '.0')"


@query("promotion_events", with_views(f"""
    SELECT model, CAST(ev_ord AS INTEGER) AS ev_ord, kind, version, alias, tag_key, tag_value FROM (
      SELECT model, 0 AS ev_ord, 'set_alias' AS kind, chall_version AS version, 'champion' AS alias,
             NULL AS tag_key, NULL AS tag_value FROM decisions WHERE promote
      UNION ALL SELECT model, 1, 'set_tag', chall_version, NULL, 'cc_result', 'promoted_to_champion' FROM decisions WHERE promote
      UNION ALL SELECT model, 2, 'set_tag', chall_version, NULL, 'cc_promoted_at', '{EVALUATED_AT}' FROM decisions WHERE promote
      UNION ALL SELECT model, 3, 'set_tag', chall_version, NULL, 'cc_score_delta', {PYSTR4.format('delta')} FROM decisions WHERE promote
      UNION ALL SELECT model, 4, 'set_tag', chall_version, NULL, 'cc_replaced_champ', champ_version FROM decisions WHERE promote
      UNION ALL SELECT model, 5, 'set_tag', champ_version, NULL, 'cc_result', 'retired_by_challenger' FROM decisions WHERE promote
      UNION ALL SELECT model, 0, 'set_tag', chall_version, NULL, 'cc_result', 'not_promoted' FROM decisions WHERE NOT promote
      UNION ALL SELECT model, 1, 'set_tag', chall_version, NULL, 'cc_rejection_reason', reason FROM decisions WHERE NOT promote
      UNION ALL SELECT model, 2, 'set_alias', champ_version, 'champion', NULL, NULL FROM decisions WHERE NOT promote) u""",
    "decisions"))
def q_promotion_events(spark, sf_dir):
    return CP.promotion_events(decisions(spark, sf_dir), EVALUATED_AT)


def deploy_candidates(spark, sf_dir):
    """Current candidates that passed staging, with the production holder
    they replace (both read from one pivoted alias row)."""
    st = state(spark, sf_dir)
    row = R.alias_row(st.aliases, ("candidate", "production")).where(
        F.col("candidate").isNotNull())
    cands = R.staging_gate(row.select("model", F.col("candidate").alias("version"),
                                      F.col("production").alias("prev_version")),
                           st.tags).where("staging_ok")
    t = H.corpus_templates(spark, sf_dir).select(
        F.col("name").alias("template"), F.col("name").alias("template_name"),
        F.col("version").alias("template_version"), F.col("model").alias("llm_model"))
    j = cands.join(lineage(spark, sf_dir), ["model", "version"]).join(bounded_broadcast(t), "template")
    return j.select("model", "version", "prev_version",
                    F.substring(F.md5("model"), 1, 12).alias("git_sha"),
                    "template_name", "template_version", "llm_model")


@query("deployment_events", with_views(f"""
    SELECT model, CAST(ev_ord AS INTEGER) AS ev_ord, kind, version, alias, tag_key, tag_value FROM (
      SELECT model, 0 AS ev_ord, 'set_alias' AS kind, version, 'production' AS alias, NULL AS tag_key,
             NULL AS tag_value FROM deploy_cands
      UNION ALL SELECT model, 1, 'set_tag', version, NULL, 'cd_production', 'deployed' FROM deploy_cands
      UNION ALL SELECT model, 2, 'set_tag', version, NULL, 'cd_deployed_at', '{DEPLOYED_AT}' FROM deploy_cands
      UNION ALL SELECT model, 3, 'set_tag', version, NULL, 'cd_approved_by', '{APPROVER}' FROM deploy_cands
      UNION ALL SELECT model, 4, 'set_tag', version, NULL, 'cd_git_sha', git_sha FROM deploy_cands
      UNION ALL SELECT model, 5, 'set_tag', version, NULL, 'cd_replaced_version', prev_version
      FROM deploy_cands WHERE prev_version IS NOT NULL) u""", "deploy_cands"))
def q_deployment_events(spark, sf_dir):
    return CP.deployment_events(deploy_candidates(spark, sf_dir), DEPLOYED_AT, APPROVER)


@query("audit_sink", with_views(f"""
    SELECT 'production_deployment' AS event, 'cd-production-' || substr(git_sha, 1, 8) AS cd_run_id,
           model AS model_name, version AS model_version, prev_version AS prev_production_version,
           template_name, template_version, llm_model, '{APPROVER}' AS approved_by, git_sha,
           'refs/heads/main' AS git_ref, '{DEPLOYED_AT}' AS deployed_at FROM deploy_cands""",
    "deploy_cands"))
def q_audit_sink(spark, sf_dir):
    from arbiter.sources import sinks
    rows = CP.audit_rows(deploy_candidates(spark, sf_dir), DEPLOYED_AT, APPROVER)
    path = sinks.fresh_path(spark, "audit")
    for _ in range(2):  # a rerun of the deployment job appends nothing
        sinks.append_audit(rows, path, key=f"deployment-{DEPLOYED_AT}")
    return sinks.read_audit(spark, path)
