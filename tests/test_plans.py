"""Physical-plan properties the design relies on."""

from arbiter.plans import experiment as X
from arbiter.plans.catalog import registry
from conftest import SF_MID


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_broadcasts_cases_and_prunes_scan(spark):
    df = registry()["best_candidate"].build(spark, SF_MID)
    p = plan_of(df)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    # only the needed document columns are read
    scan = [line for line in p.splitlines() if "Scan parquet" in line][0]
    assert "lang" not in scan and "n_chars" not in scan


def test_one_shuffle_on_template_for_the_summary(spark):
    df = X.summary(spark, SF_MID)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning(template") == 1
    assert "HashAggregate" in p   # partial + final aggregation


def test_topk_uses_group_limit_not_full_sort(spark):
    df = registry()["vector_topk"].build(spark, SF_MID)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in p
    assert "CartesianProduct" not in plan_of(df) and "NestedLoopJoin" not in plan_of(df)


def test_no_python_in_sql_expressible_queries(spark):
    for name in ("rule_score", "experiment_summary", "alias_state", "session_totals", "ops_metrics"):
        p = plan_of(registry()[name].build(spark, SF_MID))
        assert "EvalPython" not in p, name


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_pass_metric_plans(spark):
    """Two views of one relation are built in one pass, not by self-joins."""
    for name in ("drift_report", "ops_metrics", "ab_metrics_by_arm", "summary_union"):
        p = _executed(registry()[name].build(spark, SF_MID))
        assert p.count("Scan parquet") == 1, name


def test_champion_challenger_plan_stays_bounded(spark):
    p = _executed(registry()["promotion_decision"].build(spark, SF_MID))
    assert p.count("Scan parquet") <= 12
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_session_totals_reads_roles_and_tokens_without_texts_in_the_window(spark):
    from arbiter.operators import conversations as CV
    from arbiter.sources import fixtures as FX
    p = _executed(CV.session_totals(FX.turns(spark, SF_MID)))
    assert "BroadcastNestedLoopJoin" not in p
    assert all("text#" not in line for line in p.splitlines() if "Window" in line or "Exchange" in line)
