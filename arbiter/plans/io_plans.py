"""Sources and sinks: config loading, CSV scan, run log, artifacts, JSON
tables, request payloads, tool-call parsing and small projections."""

from __future__ import annotations


from pyspark.sql import functions as F

from arbiter import schemas as S
from arbiter.functions.json_fns import tool_args, tool_name
from arbiter.functions.rounding import exact_round, exact_round_sql as XR
from arbiter.operators.common import bounded_broadcast
from arbiter.plans.catalog import finalize, query
from arbiter.plans.experiment import TEMPLATE_SQL, evaluated, summary
from arbiter.plans.oracle_views import with_views
from arbiter.sources import config_source as CS
from arbiter.sources import commits
from arbiter.sources import fixtures as FX
from arbiter.sources import sinks
from arbiter.sources.local import local_table
from arbiter.sources.tables import read_table


@query("case_source", with_views("""
    SELECT c.case_id, CAST(len(c.expected_topics) AS BIGINT) AS n_topics,
           CAST(len(c.must_not_contain) AS BIGINT) AS n_must_not, CAST(c.max_words AS INTEGER) AS max_words,
           CAST(count(r.resp_id) AS BIGINT) AS n_responses
    FROM cases c LEFT JOIN responses r ON r.case_id = c.case_id
    GROUP BY c.case_id, c.expected_topics, c.must_not_contain, c.max_words""", "cases", "responses"))
def q_case_source(spark, sf_dir):
    path = sinks.fresh_path(spark, "config/cases")
    CS.write_cases(spark, FX.GOLDEN_CASES, path)
    cases = CS.require_rows(CS.load_cases(spark, path), "case")
    counts = FX.responses(spark, sf_dir).groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    j = bounded_broadcast(cases).join(counts, "case_id", "left")
    return j.select("case_id", F.size("expected_topics").cast("bigint").alias("n_topics"),
                    F.size("must_not_contain").cast("bigint").alias("n_must_not"), "max_words",
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_responses"))


@query("config_required_fields", """
    SELECT event_id AS call_id, 'k' AS missing FROM events
    WHERE NOT (event_id % 50 <> 0 AND event_id % 70 <> 0 AND json_valid(props)
               AND json_extract(props, '$.k') IS NOT NULL)""")
def q_config_required_fields(spark, sf_dir):
    # required argument keys vs the keys present in each call's argument map
    calls = FX.tool_calls(spark, sf_dir)
    miss = CS.missing_keys(tool_args("arguments"), ["k"])
    return calls.select("call_id", F.array_join(miss, ",").alias("missing")).where(
        F.col("missing") != "")


@query("default_fill", """
    SELECT event_id AS call_id,
           coalesce(nullif(CASE WHEN user_id % 2 = 0 THEN 's' || CAST(user_id AS VARCHAR) END, ''), 'default-session') AS session_or_default
    FROM events""")
def q_default_fill(spark, sf_dir):
    c = FX.tool_calls(spark, sf_dir)
    return c.select("call_id", CS.default_fill("custom_session", "default-session")
                    .alias("session_or_default"))


@query("key_set_difference", with_views("""
    SELECT m.model, r.alias AS missing_alias
    FROM (SELECT DISTINCT model FROM registry) m
    CROSS JOIN (VALUES ('candidate'), ('champion'), ('production')) r(alias)
    WHERE NOT EXISTS (SELECT 1 FROM alias_state a WHERE a.model = m.model AND a.alias = r.alias)""",
    "registry", "alias_state"))
def q_key_set_difference(spark, sf_dir):
    st = FX.registry_state(spark, sf_dir)
    required = F.array(*[F.lit(a) for a in ("candidate", "champion", "production")])
    want = st.versions.select("model").distinct().select("model", F.explode(required).alias("alias"))
    have = st.aliases.select("model", "alias")
    return want.join(have, ["model", "alias"], "left_anti").select(
        "model", F.col("alias").alias("missing_alias"))


CSV_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
# Cells of the CSV file: quantities are written as whole numbers except where
# the order key is high (so floats come late), some discounts are no numbers.
LATE_FLOAT = "l_orderkey > {0}"
BAD_DISCOUNT = "l_orderkey % 97 = 5 AND l_linenumber = 2"
_BAD_TEXT = "CASE WHEN l_orderkey % 2 = 0 THEN 'n/a' ELSE '0,05' END"
_MANY = "(SELECT max(l_orderkey) * 9 // 10 FROM lineitem)"


def lineitem_csv(spark, sf_dir):
    """The CSV input, written once per lineitem snapshot, and its scan."""
    from arbiter.sources.csv_scan import scan_csv
    from arbiter.sources.materialize import materialized_path
    from arbiter.sources.tables import table_path

    def write(path):
        li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", *CSV_COLS])
        late = LATE_FLOAT.format(li.agg(F.expr("max(l_orderkey) * 9 div 10")).first()[0])
        li.select("l_orderkey", "l_linenumber", "l_shipdate",
                  F.expr(f"CASE WHEN {late} THEN CAST(l_quantity + 0.5 AS STRING) "
                         "ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS l_quantity"),
                  F.expr(f"CASE WHEN {BAD_DISCOUNT} THEN {_BAD_TEXT} ELSE CAST(l_discount AS STRING) END AS l_discount"),
                  "l_tax", "l_extendedprice").write.option("header", True).csv(path)

    path = materialized_path(spark, "lineitem_csv", [table_path(sf_dir, "lineitem")], write)
    return scan_csv(spark, path, tolerance=0.02, carry=("l_orderkey", "l_linenumber"))


@query("csv_scan", f"""
    SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(l_quantity AS DOUBLE) + CASE WHEN {LATE_FLOAT.format(_MANY)} THEN 0.5 ELSE 0 END AS l_quantity,
           CASE WHEN NOT ({BAD_DISCOUNT}) THEN CAST(l_discount AS DOUBLE) END AS l_discount,
           CAST(l_tax AS DOUBLE) AS l_tax, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice
    FROM lineitem""")
def q_csv_scan(spark, sf_dir):
    rows = lineitem_csv(spark, sf_dir).rows
    return rows.select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in CSV_COLS])


@query("csv_rejects", f"""
    SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           'l_discount' AS column_name, {_BAD_TEXT} AS cell, 'double' AS expected
    FROM lineitem WHERE {BAD_DISCOUNT}""")
def q_csv_rejects(spark, sf_dir):
    rejects = lineitem_csv(spark, sf_dir).rejects
    return rejects.select("l_orderkey", "l_linenumber", "column_name", "cell", "expected")


@query("csv_types", f"""
    SELECT column_name, data_type, CAST(n_misfit AS BIGINT) AS n_misfit FROM (VALUES
      ('l_orderkey', 'bigint', 0), ('l_linenumber', 'bigint', 0), ('l_shipdate', 'timestamp', 0), ('l_quantity', 'double', 0),
      ('l_discount', 'double', (SELECT count(*) FROM lineitem WHERE {BAD_DISCOUNT})), ('l_tax', 'double', 0),
      ('l_extendedprice', 'double', 0)) t(column_name, data_type, n_misfit)""")
def q_csv_types(spark, sf_dir):
    from arbiter.sources.csv_scan import join_kinds
    scan = lineitem_csv(spark, sf_dir)
    return spark.createDataFrame([(c, t, join_kinds(scan.counts[c], 0.02)[1]) for c, t in scan.types.items()],
                       "column_name string, data_type string, n_misfit bigint")


@query("labelled_table_scan", """
    SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(len(embedding) AS INTEGER) AS n_features FROM embeddings""")
def q_labelled_table_scan(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = FX.vectors(spark, sf_dir).select("vec_id", "label",
                                         array_to_vector("embedding").alias("features"))
    return v.select("vec_id", F.col("label").cast("int"),
                    F.size(vector_to_array("features")).alias("n_features"))


RUN_METRICS = [("eval/rule_pass_rate", "rule_pass_rate", 3), ("eval/avg_rule_score", "avg_rule_score", 3),
               ("perf/avg_latency_ms", "avg_latency_ms", 1),
               ("perf/avg_input_tokens", "avg_input_tokens", 1),
               ("perf/avg_output_tokens", "avg_output_tokens", 1)]


def logged_runs(spark, sf_dir):
    """The evaluation runs of the corpus, logged and read back."""
    from arbiter.functions import hashing as H
    s = summary(spark, sf_dir)
    t = H.corpus_templates(spark, sf_dir)
    t = t.select(F.col("name").alias("template"), F.col("version").alias("tpl_version"),
                 H.config_hash(t).alias("tpl_hash"), "model", "temperature", "max_tokens",
                 F.size("few_shots").alias("few_shot_count"))
    wide = s.join(bounded_broadcast(t), "template").select(
        F.col("template").alias("run_id"), F.col("template").alias("tpl_name"), "tpl_version",
        "tpl_hash", "model", "temperature", "max_tokens", "few_shot_count",
        F.lit("False").alias("judge_enabled"), F.col("n_cases").cast("string").alias("eval_set_size"),
        *[exact_round(c, d).alias(c) for _, c, d in RUN_METRICS])
    root = sinks.fresh_path(spark, "runs")
    job = dict(
        run_date="2024-06-01", run_id="run_id",
        params=[("tpl_name", "template.name"), ("tpl_version", "template.version"),
                ("tpl_hash", "template.config_hash"), "model", "temperature", "max_tokens",
                "few_shot_count"],
        metrics=[(c, k) for k, c, _ in RUN_METRICS],
        tags=[("tpl_name", "template.name"), ("tpl_version", "template.version"),
              "eval_set_size", "judge_enabled"], key="corpus-evaluation-2024-06-01")
    sinks.log_runs(wide, root, **job)
    sinks.log_runs(wide, root, **job)  # the same job once more leaves one set of rows
    return sinks.read_run_log(spark, root)


@query("run_log_sink", with_views(" UNION ALL ".join(
    f"SELECT template AS run_id, '{k}' AS key, {XR(c, d)} AS value FROM summary"
    for k, c, d in RUN_METRICS), "summary"))
def q_run_log_sink(spark, sf_dir):
    return logged_runs(spark, sf_dir).where(F.col("kind") == "metric").select(
        "run_id", "key", F.col("number").alias("value"))


# (kind, logged key, text) of a run's parameters and tags
RUN_TEXTS = [("param", "template.name", "s.template"), ("param", "template.version", "t.version"),
             ("param", "template.config_hash", """substr(sha256(
        '{"few_shots": [], "max_tokens": 1024, "model": "' || t.model || '", "name": "' || t.name
        || '", "system": "' || t.system || '", "temperature": 0.3, "version": "' || t.version || '"}'), 1, 12)"""),
             ("param", "model", "t.model"), ("param", "temperature", "'0.3'"), ("param", "max_tokens", "'1024'"),
             ("param", "few_shot_count", "'0'"), ("tag", "template.name", "s.template"),
             ("tag", "template.version", "t.version"), ("tag", "eval_set_size", "CAST(s.n_cases AS VARCHAR)"),
             ("tag", "judge_enabled", "'False'")]


@query("run_log_params_tags", with_views(" UNION ALL ".join(
    f"SELECT s.template AS run_id, '{kind}' AS kind, '{key}' AS key, {text} AS text "
    f"FROM summary s JOIN ({TEMPLATE_SQL}) t ON t.name = s.template" for kind, key, text in RUN_TEXTS), "summary"))
def q_run_log_params_tags(spark, sf_dir):
    return logged_runs(spark, sf_dir).where(F.col("kind") != "metric").select("run_id", "kind", "key", "text")


@query("artifact_json_sink", with_views("""
    SELECT template, resp_id, score, passed, array_to_string(topic_misses, ',') AS topic_misses
    FROM evaluated""", "evaluated"))
def q_artifact_json_sink(spark, sf_dir):
    rec = evaluated(spark, sf_dir).select(
        "template", "resp_id", "score", "passed",
        F.array_join("topic_misses", ",").alias("topic_misses"))
    path = sinks.fresh_path(spark, "artifacts/eval_results")
    sinks.write_artifacts(rec, path, "template")
    back = sinks.read_artifacts(spark, path, "resp_id BIGINT, score DOUBLE, passed BOOLEAN, "
                                              "topic_misses STRING, template STRING")
    return back.select("template", "resp_id", "score", "passed", "topic_misses")


@query("artifact_latest_read", with_views("""
    SELECT template, resp_id, CASE WHEN ord % 2 = 0 THEN 2 ELSE 1 END AS gen FROM evaluated""",
    "evaluated"))
def q_artifact_latest_read(spark, sf_dir):
    schema = "resp_id BIGINT, ord INT, gen INT, template STRING"
    rec = evaluated(spark, sf_dir).select("template", "ord", "resp_id", F.lit(1).alias("gen")).repartition(4, "resp_id")
    path = sinks.fresh_path(spark, "artifacts/prompt_config")
    sinks.write_artifacts(rec, path, "template", key="first")      # several tasks write every run
    first = sinks.read_newest_generation(spark, path, schema, "template")
    again = first.where(F.col("ord") % 2 == 0).withColumn("gen", F.lit(2)).repartition(3, "resp_id")
    sinks.write_artifacts(again, path, "template", key="second")
    # a job that died before its commit: its files are there, nobody sees them
    commits.stage(first.withColumn("gen", F.lit(3)), path, ["template"], "json", ["template"])
    latest = sinks.read_newest_generation(spark, path, schema, "template")
    return latest.select("template", "resp_id", "gen")


@query("table_json_sink", with_views("""
    SELECT template, round_even(rule_pass_rate, 6) AS rule_pass_rate FROM summary""", "summary"))
def q_table_json_sink(spark, sf_dir):
    t = finalize(summary(spark, sf_dir).select("template", "rule_pass_rate"))
    path = sinks.fresh_path(spark, "tables/leaderboard")
    sinks.write_json_table(t, path)
    return spark.read.schema("template STRING, rule_pass_rate DOUBLE").json(path)


@query("request_payload", """
    SELECT part, (rn - 1) // 100 AS batch_id, CAST(count(*) AS BIGINT) AS n_rows,
           '{"dataframe_split":{"columns":["resp_id","input_tokens","output_tokens"],"data":['
           || string_agg('[' || CAST(resp_id AS VARCHAR) || ',' || CAST(input_tokens AS VARCHAR) || ','
                         || CAST(output_tokens AS VARCHAR) || ']', ',' ORDER BY resp_id) || ']}}' AS payload
    FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY resp_id, input_tokens, output_tokens) AS rn FROM (
      SELECT *, CAST('0x' || substr(md5(concat_ws('|', resp_id, input_tokens, output_tokens)), 1, 8) AS BIGINT)
             % (SELECT greatest(1, (count(*) + 9999) // 10000) FROM documents) AS part
    FROM (SELECT doc_id AS resp_id, CAST(40 + 10 * CAST(substr(source, 4) AS INTEGER) AS BIGINT) AS input_tokens,
                 CAST(floor(len(regexp_extract_all(text, '\\S+')) * CAST(1.3 AS DOUBLE)) AS BIGINT) AS output_tokens
          FROM documents) r0) r1) r GROUP BY part, (rn - 1) // 100""")
def q_request_payload(spark, sf_dir):
    from arbiter.operators.scoring import request_payload
    r = FX.responses(spark, sf_dir).select("resp_id", "input_tokens", "output_tokens")
    return request_payload(r, "resp_id", ["resp_id", "input_tokens", "output_tokens"], 100)


@query("tool_call_parse", """
    SELECT event_id AS call_id, replace('cat__sch__' || event_type, '__', '.') AS tool,
           CASE WHEN json_valid(args) THEN len(json_keys(args)) ELSE 0 END AS n_args,
           CASE WHEN json_valid(args) THEN json_extract_string(args, '$.k') END AS k
    FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN '{bad' WHEN event_id % 70 = 0 THEN props || ' junk'
                         ELSE props END AS args FROM events) e""")
def q_tool_call_parse(spark, sf_dir):
    c = FX.tool_calls(spark, sf_dir)
    m = tool_args("arguments")
    return c.select("call_id", tool_name("name").alias("tool"),
                    F.size(m).cast("bigint").alias("n_args"), m["k"].alias("k"))


@query("session_key", """
    SELECT event_id AS call_id,
           coalesce(CASE WHEN user_id % 2 = 0 THEN 's' || CAST(user_id AS VARCHAR) END,
                    'c' || CAST(user_id AS VARCHAR)) AS session_id
    FROM events""")
def q_session_key(spark, sf_dir):
    c = FX.tool_calls(spark, sf_dir)
    return c.select("call_id", F.coalesce("custom_session", "context_conversation").alias("session_id"))


@query("terminal_event_filter", """
    SELECT event_id, event_id // 3 AS request_id, user_id FROM events WHERE event_type = 'purchase'""")
def q_terminal_event_filter(spark, sf_dir):
    # the terminal event type is a parameter ('response.output_item.done' for
    # agent streams); on the telemetry fixture it is 'purchase'
    t = FX.telemetry(spark, sf_dir)
    return t.where(F.col("event_type") == "purchase").select("event_id", "request_id", "user_id")


@query("metric_type_filter", """
    SELECT event_id AS call_id, round_even(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 6) AS value
    FROM events WHERE event_id % 40 <> 0 AND TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) IS NOT NULL""")
def q_metric_type_filter(spark, sf_dir):
    c = FX.tool_calls(spark, sf_dir).select("call_id", F.col("metric_value").alias("value"))
    return finalize(sinks.numeric_metrics(c))


TOOLS = [("cat.sch.click", "record a click"), ("cat.sch.view", "record a view"),
         ("cat.sch.purchase", "record a purchase")]


@query("tool_lookup", """
    SELECT e.event_id AS call_id, replace('cat__sch__' || e.event_type, '__', '.') AS tool,
           t.description, t.description IS NULL AS unknown_tool
    FROM events e LEFT JOIN (VALUES ('cat.sch.click', 'record a click'), ('cat.sch.view', 'record a view'),
                                    ('cat.sch.purchase', 'record a purchase')) t(name, description)
      ON t.name = replace('cat__sch__' || e.event_type, '__', '.')""")
def q_tool_lookup(spark, sf_dir):
    c = FX.tool_calls(spark, sf_dir).select("call_id", tool_name("name").alias("tool"))
    tools = local_table(spark, TOOLS, S.TOOL).withColumnRenamed("name", "tool")
    j = c.join(bounded_broadcast(tools), "tool", "left")
    return j.select("call_id", "tool", "description",
                    F.col("description").isNull().alias("unknown_tool"))


@query("template_source", """
    SELECT name, CASE WHEN ord % 5 = 0 THEN '1.0.0' ELSE '2.' || ord END AS version,
           CASE WHEN ord % 3 = 0 THEN 0.3 ELSE 0.7 END::DOUBLE AS temperature,
           CAST(CASE WHEN ord % 4 = 0 THEN 1024 ELSE 256 END AS INTEGER) AS max_tokens, CAST(0 AS BIGINT) AS n_shots
    FROM (SELECT DISTINCT source AS name, CAST(substr(source, 4) AS INTEGER) AS ord FROM documents) t""")
def q_template_source(spark, sf_dir):
    # a template file in which some fields are absent, loaded with the defaults
    d = read_table(spark, sf_dir, "documents", ["source"]).distinct()
    ord_ = F.substring("source", 4, 16).cast("int")
    path = sinks.fresh_path(spark, "config/templates")
    d.select(F.col("source").alias("name"), F.when(ord_ % 5 != 0, F.concat(F.lit("2."), ord_)).alias("version"),
             F.lit("sys").alias("system"), F.when(ord_ % 3 != 0, F.lit(0.7)).alias("temperature"),
             F.when(ord_ % 4 != 0, F.lit(256)).alias("max_tokens")).write.json(path)
    t = CS.require_rows(CS.load_templates(spark, path), "template")
    return t.select("name", "version", "temperature", "max_tokens", F.size("few_shots").cast("bigint").alias("n_shots"))


@query("probe_source", """
    SELECT 'smoke-' || (doc_id % 3) AS probe_id, 8000.0::DOUBLE AS max_latency_ms, CAST(count(*) AS BIGINT) AS n_responses,
           CAST(count(*) FILTER (CASE doc_id % 3 WHEN 0 THEN contains(lower(text), 'the') AND contains(lower(text), 'tion')
                                 WHEN 1 THEN contains(lower(text), 'est') ELSE true END) AS BIGINT) AS n_contains_ok
    FROM documents GROUP BY doc_id % 3""")
def q_probe_source(spark, sf_dir):
    from arbiter.operators import summaries as SM
    path = sinks.fresh_path(spark, "config/probes")
    FX.smoke_probes(spark).select(F.col("probe_id").alias("id"), "user_message", F.expr(
        "nullif(must_contain, cast(array() as array<string>))").alias("must_contain"), "must_not_contain",
        "max_latency_ms").write.json(path)   # an empty list and a NULL limit are left out of the file
    probes = CS.require_rows(CS.load_probes(spark, path), "probe")
    r = FX.responses(spark, sf_dir).withColumn("probe_id", F.concat(F.lit("smoke-"), F.col("resp_id") % 3))
    checked = SM.probe_checks(r, probes).groupBy("probe_id").agg(
        F.count(F.lit(1)).alias("n_responses"), F.count_if("contains_ok").alias("n_contains_ok"))
    return probes.select("probe_id", "max_latency_ms").join(checked, "probe_id")
