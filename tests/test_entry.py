import re

import __spark_entry__ as E

SURVEY_KEYS = """case_source config_required_fields csv_scan labelled_table_scan run_log_sink artifact_json_sink
artifact_latest_read table_json_sink audit_sink request_payload topic_hits violations word_count_limit cta_flag
rule_score token_cost approx_tokens judge_parse judge_prompt message_assembly config_hash run_name text_clean
prompt_render scorer_exact_match scorer_is_json scorer_min_items probe_check display_projection default_fill
tool_call_parse session_key terminal_event_filter metric_type_filter reason_text experiment_grid
response_case_join paired_compare summary_template_lookup positional_align tool_lookup alias_fallback_join
registry_lineage_join turn_pair_asof same_version_guard experiment_summary ci_summary composite_score
quality_gates smoke_summary session_totals history_fold prediction_mse classification_metrics scorer_report
mean_pool ordered_concat conversation_status step_index reset_segments previous_alias_version parent_child_runs
leaderboard best_candidate latest_version case_sample summary_union key_set_difference split_partition
score_udf_sql batch_generate batch_judge embed_texts scorer_plugin alias_batch_inference retrying_call
register_version alias_state tag_state staging_gate approval_gate promotion_decision promotion_events
deployment_events train_gbt train_rf train_logreg model_compare stream_turn_metrics stream_attempt_outcomes
stream_session_totals stream_history_state stream_gate_alerts traffic_split drift_report ops_metrics
vector_topk ab_metrics_by_arm""".split()


def test_every_survey_operator_is_registered():
    assert len(SURVEY_KEYS) == 98
    missing = set(SURVEY_KEYS) - set(E.queries())
    assert not missing


def test_oracles_belong_to_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    for name, sql in E.oracle_sql().items():
        assert not re.search(r"\blimit\s+\d+", sql, re.I) or name.startswith("best_candidate"), name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and "composite" in df.columns


def test_settings_of_one_query_do_not_stay(spark):
    from arbiter.session import apply_runtime_conf, override_conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    apply_runtime_conf(spark)
    before = spark.conf.get(key)
    override_conf(spark, {key: "7"})
    override_conf(spark, {key: "9"})
    assert spark.conf.get(key) == "9"
    apply_runtime_conf(spark)
    assert spark.conf.get(key) == before
