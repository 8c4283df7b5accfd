"""The engine's derived inputs restated as DuckDB SQL views (for oracles).

``with_views(body, "evaluated", ...)`` prefixes ``body`` with a WITH clause
holding the named views and everything they depend on, in dependency order.
"""

from __future__ import annotations

from arbiter.functions.rounding import exact_round_sql as XR
from arbiter.sources import fixtures as FX


def _lit_list(items) -> str:
    if not items:
        return "CAST([] AS VARCHAR[])"
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _cases_sql() -> str:
    rows = ", ".join(
        f"('{cid}', '{msg}', {_lit_list(t)}, {_lit_list(m)}, {mw})"
        for cid, msg, t, m, mw in FX.GOLDEN_CASES)
    return (f"SELECT * FROM (VALUES {rows}) "
            "AS t(case_id, user_message, expected_topics, must_not_contain, max_words)")


def _probes_sql() -> str:
    rows = ", ".join(
        f"('{pid}', '{msg}', {_lit_list(mc)}, {_lit_list(mn)}, "
        f"{'CAST(NULL AS DOUBLE)' if lim is None else f'CAST({lim} AS DOUBLE)'})"
        for pid, msg, mc, mn, lim in FX.SMOKE_PROBES)
    return (f"SELECT * FROM (VALUES {rows}) "
            "AS t(probe_id, user_message, must_contain, must_not_contain, max_latency_ms)")


WC = "CAST(len(regexp_extract_all({0}, '\\S+')) AS BIGINT)"
TOK = "CAST(floor(" + WC + " * CAST(1.3 AS DOUBLE)) AS BIGINT)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "responses": ((), f"""
        SELECT doc_id AS resp_id, source AS template,
               CAST(substr(source, 4) AS INTEGER) AS ord,
               'case-' || CAST((doc_id // 20) % 5 AS VARCHAR) AS case_id,
               text AS response,
               CAST((doc_id * 7919) % 90010 AS DOUBLE) / 10.0 AS latency_ms,
               CAST(40 + 10 * CAST(substr(source, 4) AS INTEGER) AS BIGINT) AS input_tokens,
               {TOK.format('text')} AS output_tokens
        FROM documents"""),
    "cases": ((), _cases_sql()),
    "probes": ((), _probes_sql()),
    "ruled": (("responses", "cases"), f"""
        SELECT r.*, c.user_message, c.expected_topics, c.must_not_contain, c.max_words,
               CAST(len(list_filter(c.expected_topics, lambda t: contains(lower(r.response), lower(t)))) AS BIGINT) AS topic_hits,
               list_filter(c.expected_topics, lambda t: NOT contains(lower(r.response), lower(t))) AS topic_misses,
               list_filter(c.must_not_contain, lambda t: contains(lower(r.response), lower(t))) AS must_not_violated,
               {WC.format('r.response')} AS word_count,
               contains(lower(r.response), '{FX.CORPUS_CTA}') AS ends_with_cta,
               len(c.expected_topics) AS n_topics
        FROM responses r JOIN cases c USING (case_id)"""),
    "scored": (("ruled",), """
        SELECT *, greatest(CAST(0.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE),
                 (CAST(topic_hits AS DOUBLE) / CAST(greatest(n_topics, 1) AS DOUBLE)
                  - CAST(len(must_not_violated) AS DOUBLE) * CAST(0.25 AS DOUBLE))
                 + CASE WHEN ends_with_cta THEN CAST(0.1 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)) AS score_raw
        FROM ruled"""),
    "evaluated": (("scored",), f"""
        SELECT *, (score_raw >= 0.6 AND len(must_not_violated) = 0) AS passed,
               {XR('score_raw', 3)} AS score,
               word_count <= max_words AS within_word_limit,
               {XR('cost_raw', 6)} AS cost_usd
        FROM (SELECT *, (CAST(input_tokens AS DOUBLE) / 1000.0) * CAST(0.0025 AS DOUBLE)
                        + (CAST(output_tokens AS DOUBLE) / 1000.0) * CAST(0.01 AS DOUBLE) AS cost_raw
              FROM scored) sc"""),
    "summary": (("evaluated",), """
        SELECT template, ord, CAST(count(*) AS BIGINT) AS n_cases,
               avg(CAST(passed AS INTEGER)) AS rule_pass_rate,
               (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS avg_rule_score, (CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / CAST(10 * count(latency_ms) AS DOUBLE)) AS avg_latency_ms,
               avg(input_tokens) AS avg_input_tokens, avg(output_tokens) AS avg_output_tokens,
               CAST(0.0 AS DOUBLE) AS avg_judge_score, (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS composite
        FROM evaluated GROUP BY template, ord"""),
}


JUDGE_BODY = (
    "'{\"helpfulness\": ' || CAST(1 + 4 * coalesce(CAST(l.quality AS BIGINT), d.doc_id % 2) AS VARCHAR)"
    " || ', \"faithfulness\": ' || CAST(5 - d.doc_id % 3 AS VARCHAR)"
    " || ', \"conciseness\": ' || CAST(1 + d.doc_id % 5 AS VARCHAR)"
    " || ', \"safety\": ' || CAST(5 - 4 * coalesce(CAST(l.toxic AS BIGINT), 0) AS VARCHAR)"
    " || ', \"reasoning\": \"r' || CAST(d.doc_id AS VARCHAR) || '\"}'")

VIEWS["judge_raw"] = ((), f"""
    SELECT resp_id, template, case_id,
           CASE WHEN CAST(substr(template, 4) AS INTEGER) % 4 = 0 THEN NULL
                WHEN resp_id % 97 = 0 THEN 'not json'
                WHEN resp_id % 89 = 0 THEN body || ' Hope this helps!'
                WHEN resp_id % 3 = 0 THEN body
                WHEN resp_id % 3 = 1 THEN '```json' || chr(10) || body || chr(10) || '```'
                ELSE '```' || chr(10) || body || chr(10) || '```' END AS judge_raw
    FROM (SELECT d.doc_id AS resp_id, d.source AS template,
                 'case-' || CAST((d.doc_id // 20) % 5 AS VARCHAR) AS case_id, {JUDGE_BODY} AS body
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) x""")

STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"

VIEWS["judge_parsed"] = (("judge_raw",), f"""
    SELECT resp_id, template, case_id, judge_raw, h AS judge_helpfulness, f AS judge_faithfulness,
           c AS judge_conciseness, s AS judge_safety, coalesce(reasoning, '') AS judge_reasoning,
           CASE WHEN ok THEN {XR('((((h + f) + c) + s) / 4.0)', 2)} END AS judge_avg, ok AS judge_ok
    FROM (SELECT *, coalesce(h IS NOT NULL AND f IS NOT NULL AND c IS NOT NULL AND s IS NOT NULL, false) AS ok FROM (
      SELECT *,
        CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.helpfulness') AS DOUBLE) END AS h,
        CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.faithfulness') AS DOUBLE) END AS f,
        CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.conciseness') AS DOUBLE) END AS c,
        CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.safety') AS DOUBLE) END AS s,
        CASE WHEN json_valid(body) THEN json_extract_string(body, '$.reasoning') END AS reasoning
      FROM (SELECT *, {STRIP.format("CASE WHEN starts_with(r1, 'json') THEN substr(r1, 5) ELSE r1 END")} AS body
            FROM (SELECT *, CASE WHEN starts_with(r0, '```') THEN coalesce(string_split(r0, '```')[2], '') ELSE r0 END AS r1
                  FROM (SELECT *, {STRIP.format('judge_raw')} AS r0 FROM judge_raw) a) b) c0) c1) c2""")

VIEWS["judged"] = (("evaluated", "judge_parsed"), """
    SELECT e.*, j.judge_avg, j.judge_helpfulness, j.judge_faithfulness, j.judge_conciseness, j.judge_safety
    FROM evaluated e LEFT JOIN (SELECT * FROM judge_parsed WHERE judge_ok) j ON j.resp_id = e.resp_id""")

VIEWS["summary_judge"] = (("judged",), """
    SELECT template, ord, CAST(count(*) AS BIGINT) AS n_cases,
           avg(CAST(passed AS INTEGER)) AS rule_pass_rate, (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) AS avg_rule_score,
           (CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / CAST(10 * count(latency_ms) AS DOUBLE)) AS avg_latency_ms, avg(input_tokens) AS avg_input_tokens,
           avg(output_tokens) AS avg_output_tokens, CAST(count(judge_avg) AS BIGINT) AS n_judged,
           coalesce((CAST(sum(CAST(round(judge_avg * 100) AS BIGINT)) AS DOUBLE) / CAST(100 * count(judge_avg) AS DOUBLE)), CAST(0.0 AS DOUBLE)) AS avg_judge_score,
           avg(judge_helpfulness) AS avg_judge_helpfulness, avg(judge_faithfulness) AS avg_judge_faithfulness,
           avg(judge_conciseness) AS avg_judge_conciseness, avg(judge_safety) AS avg_judge_safety,
           CASE WHEN coalesce((CAST(sum(CAST(round(judge_avg * 100) AS BIGINT)) AS DOUBLE) / CAST(100 * count(judge_avg) AS DOUBLE)), 0.0) <> 0 THEN (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) * 0.5 + ((CAST(sum(CAST(round(judge_avg * 100) AS BIGINT)) AS DOUBLE) / CAST(100 * count(judge_avg) AS DOUBLE)) / 5.0) * 0.5
                ELSE (CAST(sum(CAST(round(score * 1000) AS BIGINT)) AS DOUBLE) / CAST(1000 * count(score) AS DOUBLE)) END AS composite
    FROM judged GROUP BY template, ord""")


def with_views(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        deps, _ = VIEWS[n]
        for d in deps:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"


def register_view(name: str, deps: tuple[str, ...], sql: str) -> None:
    if name in VIEWS:
        raise ValueError(f"duplicate view {name}")
    VIEWS[name] = (deps, sql)


# --- registry events (F5) and registry state ------------------------------------
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
register_view("reg_src", (), f"""
    SELECT CAST(user_id AS VARCHAR) AS model, event_id AS seq, event_type, {_K} AS k,
           sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (
             PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_reg
    FROM events""")
register_view("registry", ("reg_src",), """
    SELECT model, seq, kind, version, alias, tag_key, tag_value, 'run-' || CAST(seq AS VARCHAR) AS run_id
    FROM (
      SELECT model, seq, 'register' AS kind, CAST(n_reg AS VARCHAR) AS version, CAST(NULL AS VARCHAR) AS alias,
             CAST(NULL AS VARCHAR) AS tag_key, CAST(NULL AS VARCHAR) AS tag_value
      FROM reg_src WHERE n_reg > 0 AND event_type = 'signup'
      UNION ALL SELECT model, seq, 'set_alias', CAST(n_reg AS VARCHAR), 'candidate', NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'view'
      UNION ALL SELECT model, seq, 'set_alias', CAST(n_reg AS VARCHAR), 'production', NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'purchase'
      UNION ALL SELECT model, seq, 'set_tag', CAST(n_reg AS VARCHAR), NULL, 'cd_production', 'deployed'
      FROM reg_src WHERE n_reg > 0 AND event_type = 'purchase'
      UNION ALL SELECT model, seq, 'set_alias', CAST(n_reg AS VARCHAR), 'champion', NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'click' AND k % 2 = 0
      UNION ALL SELECT model, seq, 'set_tag', CAST(n_reg AS VARCHAR), NULL, 'cd_staging',
             CASE WHEN k < 70 THEN 'pass' ELSE 'fail' END
      FROM reg_src WHERE n_reg > 0 AND event_type = 'click' AND k % 2 <> 0
      UNION ALL SELECT model, seq, 'delete_alias', NULL, 'candidate', NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'error' AND k < 50
      UNION ALL SELECT model, seq, 'delete_version', CAST(1 + k % 5 AS VARCHAR), NULL, NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'error' AND k >= 50 AND k <> 99
      UNION ALL SELECT model, seq, 'delete_model', NULL, NULL, NULL, NULL
      FROM reg_src WHERE n_reg > 0 AND event_type = 'error' AND k = 99) u""")
register_view("vdel", ("registry",), """
    SELECT r.model, r.version, min(d.seq) AS del_seq
    FROM registry d JOIN (SELECT model, version, min(seq) AS reg_seq FROM registry
                          WHERE kind = 'register' GROUP BY model, version) r
      ON d.model = r.model AND d.seq > r.reg_seq
     AND (d.kind = 'delete_model' OR d.kind = 'delete_version' AND d.version = r.version)
    GROUP BY r.model, r.version""")
register_view("alias_state", ("registry", "vdel"), """
    SELECT model, alias, version, seq AS set_seq FROM (
      SELECT *, row_number() OVER (PARTITION BY model, alias ORDER BY seq DESC) AS rn FROM (
        SELECT s.model, s.alias, s.version, s.seq, v.del_seq
        FROM registry s LEFT JOIN vdel v ON s.model = v.model AND s.version = v.version
        WHERE s.kind = 'set_alias' AND (v.del_seq IS NULL OR s.seq < v.del_seq)
        UNION ALL
        SELECT model, alias, NULL, seq, NULL FROM registry WHERE kind = 'delete_alias') w) t
    WHERE rn = 1 AND version IS NOT NULL AND del_seq IS NULL
      AND NOT EXISTS (SELECT 1 FROM registry m WHERE m.kind = 'delete_model' AND m.model = t.model
                      AND m.seq > t.seq)""")
register_view("tag_state", ("registry", "vdel"), """
    SELECT model, version, tag_key, tag_value, seq AS set_seq FROM (
      SELECT s.model, s.version, s.tag_key, s.tag_value, s.seq,
             row_number() OVER (PARTITION BY s.model, s.version, s.tag_key ORDER BY s.seq DESC) AS rn
      FROM registry s LEFT JOIN vdel v ON s.model = v.model AND s.version = v.version
      WHERE s.kind = 'set_tag' AND v.del_seq IS NULL) t
    WHERE rn = 1""")
