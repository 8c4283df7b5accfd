"""Scorers, prompt rendering and smoke probes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.functions.json_fns import min_items
from arbiter.functions.prompts import render, unresolved
from arbiter.functions.text import text_clean
from arbiter.operators import scorers as SC
from arbiter.operators import summaries as SM
from arbiter.operators.common import bounded_broadcast
from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import register_view, with_views
from arbiter.sources import fixtures as FX
from arbiter.sources.tables import read_table

_P = {name: tmpl for name, _, tmpl, _ in FX.PROMPTS}
CLEAN_SQL = ("trim(regexp_replace(regexp_replace(lower({0}), '[^a-zA-Z0-9\\s]', ' ', 'g'), "
             "'\\s+', ' ', 'g'))")


def _sq(s: str) -> str:
    return s.replace("'", "''")


@query("prompt_render", f"""
    SELECT 'assistant_prompt' AS prompt, item_id AS item, CAST(length(r) AS BIGINT) AS chars, md5(r) AS digest,
           regexp_matches(r, '\\{{\\{{[A-Za-z_][A-Za-z0-9_]*\\}}\\}}') AS unresolved
    FROM (SELECT item_id, replace('{_sq(_P["assistant_prompt"])}', '{{{{question}}}}', text) AS r FROM benchmark) b
    UNION ALL
    SELECT 'resume_prompt', page_id, CAST(length(r) AS BIGINT), md5(r),
           regexp_matches(r, '\\{{\\{{[A-Za-z_][A-Za-z0-9_]*\\}}\\}}')
    FROM (SELECT page_id, replace('{_sq(_P["resume_prompt"])}', '{{{{clean_resume_text}}}}', {CLEAN_SQL.format('html')}) AS r
          FROM pages) p""")
def q_prompt_render(spark, sf_dir):
    prompts = bounded_broadcast(FX.prompts(spark).select(F.col("name").alias("prompt"), "template"))
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"]).select(
        F.lit("assistant_prompt").alias("prompt"), F.col("item_id").alias("item"),
        F.create_map(F.lit("question"), F.col("text")).alias("vars"))
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"]).select(
        F.lit("resume_prompt").alias("prompt"), F.col("page_id").alias("item"),
        F.create_map(F.lit("clean_resume_text"), text_clean("html")).alias("vars"))
    rows = b.unionByName(p).join(prompts, "prompt")
    r = rows.select("prompt", "item", render("template", "vars").alias("r"))
    return r.select("prompt", "item", F.length("r").cast("bigint").alias("chars"),
                    F.md5("r").alias("digest"), unresolved("r").alias("unresolved"))


@query("scorer_exact_match", r"""
    SELECT item_id, CAST(regexp_replace(text, '[.!?]\s+', '. ', 'g') IS NOT DISTINCT FROM text AS INTEGER) AS exact_match
    FROM benchmark""")
def q_scorer_exact_match(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    out = b.select("item_id", F.regexp_replace("text", r"[.!?]\s+", ". ").alias("output"),
                   F.col("text").alias("expected"))
    return out.select("item_id", SC.exact_match("output", "expected").alias("exact_match"))


def skills_rows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    js = F.to_json(F.struct(F.split("text", "\n").alias("skills")))  # the whole text, line by line
    out = F.when(F.col("doc_id") % 13 == 0, F.lit('{"skills": [')).otherwise(js)
    return d.select("doc_id", out.alias("output"), F.lit('{"skills": []}').alias("expected"))


SKILLS_SQL = """
    SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '{"skills": ['
                        ELSE CAST(to_json(struct_pack(skills := string_split(text, chr(10)))) AS VARCHAR)
                   END AS output, '{"skills": []}' AS expected FROM documents"""
register_view("skills", (), SKILLS_SQL)
MIN_ITEMS_SQL = ("coalesce(json_array_length(CASE WHEN json_valid(output) THEN output END, '$.skills') > 5, "
                 "false)")


@query("scorer_min_items", with_views(f"""
    SELECT doc_id, {MIN_ITEMS_SQL} AS minimum_five_skills FROM skills""", "skills"))
def q_scorer_min_items(spark, sf_dir):
    s = skills_rows(spark, sf_dir)
    return s.select("doc_id", min_items("output").alias("minimum_five_skills"))


@query("scorer_report", with_views(f"""
    SELECT scorer, CAST(count(value) AS BIGINT) AS n, round_even(avg(value), 6) AS mean FROM (
      SELECT 'exact_match' AS scorer, CAST(output IS NOT DISTINCT FROM expected AS DOUBLE) AS value FROM skills
      UNION ALL SELECT 'is_json', CAST(json_valid(output) AS DOUBLE) FROM skills
      UNION ALL SELECT 'minimum_five_skills', CAST({MIN_ITEMS_SQL} AS DOUBLE) FROM skills) u
    GROUP BY scorer""", "skills"))
def q_scorer_report(spark, sf_dir):
    rep = SC.scorer_report(skills_rows(spark, sf_dir), SC.default_registry(), ["doc_id"])
    return finalize(rep.select("scorer", F.col("n").cast("bigint"), "mean"))


def _word_count_py(texts: pd.Series) -> pd.Series:
    return texts.fillna("").str.split().str.len().astype("float64")


@query("scorer_plugin", """
    SELECT doc_id, 'long_answer' AS scorer, CAST(len(regexp_extract_all(text, '\\S+')) > 100 AS DOUBLE) AS value
    FROM documents
    UNION ALL
    SELECT doc_id, 'mentions_cta', CAST(contains(lower(text), 'thre') AS DOUBLE) FROM documents""")
def q_scorer_plugin(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    reg = SC.ScorerRegistry()
    wc = SC.python_scorer(_word_count_py, T.DoubleType())
    reg.register("long_answer", lambda: wc(F.col("text")) > 100)
    reg.register("mentions_cta", lambda: F.contains(F.lower("text"), F.lit(FX.CORPUS_CTA)))
    return SC.apply_scorers(d, reg, ["doc_id"])


register_view("probe_checks", ("responses", "probes"), """
    SELECT resp_id, template, probe_id, latency_ms, response, missing, violating,
           len(missing) = 0 AS contains_ok, len(violating) = 0 AS not_contains_ok, latency_ok,
           len(missing) = 0 AND len(violating) = 0 AND latency_ok AS passed
    FROM (SELECT r.resp_id, r.template, p.probe_id, r.latency_ms, r.response,
                 list_filter(p.must_contain, lambda k: NOT contains(lower(r.response), lower(k))) AS missing,
                 list_filter(p.must_not_contain, lambda k: contains(lower(r.response), lower(k))) AS violating,
                 r.latency_ms <= coalesce(p.max_latency_ms, 8000.0) AS latency_ok
          FROM responses r JOIN probes p ON p.probe_id = 'smoke-' || CAST(r.resp_id % 3 AS VARCHAR)) t""")


def probe_checks(spark, sf_dir):
    r = FX.responses(spark, sf_dir).withColumn(
        "probe_id", F.concat(F.lit("smoke-"), (F.col("resp_id") % 3).cast("string")))
    return SM.probe_checks(r, FX.smoke_probes(spark))


@query("probe_check", with_views("""
    SELECT resp_id, probe_id, contains_ok, not_contains_ok, latency_ok, passed,
           array_to_string(missing, ',') AS missing, array_to_string(violating, ',') AS violating,
           substr(response, 1, 120) AS reply_snippet FROM probe_checks""", "probe_checks"))
def q_probe_check(spark, sf_dir):
    c = probe_checks(spark, sf_dir)
    return c.select("resp_id", "probe_id", "contains_ok", "not_contains_ok", "latency_ok", "passed",
                    F.array_join("missing", ",").alias("missing"),
                    F.array_join("violating", ",").alias("violating"), "reply_snippet")


@query("smoke_summary", with_views("""
    SELECT template, coalesce(bool_and(passed), false) AND count(*) > 0 AS all_passed,
           round_even(avg(CAST(passed AS INTEGER)), 6) AS smoke_pass_rate,
           round_even(CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / CAST(10 * count(latency_ms) AS DOUBLE), 6) AS avg_latency_ms,
           CAST(count(*) AS BIGINT) AS n_probes
    FROM probe_checks GROUP BY template""", "probe_checks"))
def q_smoke_summary(spark, sf_dir):
    return finalize(SM.smoke_summary(probe_checks(spark, sf_dir)))
