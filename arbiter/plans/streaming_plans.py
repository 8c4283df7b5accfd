"""Streaming queries, each compared with its full batch twin."""

from __future__ import annotations

from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import with_views
from arbiter.sources import fixtures as FX
from arbiter.streaming import metrics as SM

MEAN_LAT = ("CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / "
            "CAST(10 * count(latency_ms) AS DOUBLE)")


@query("stream_turn_metrics", with_views(f"""
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
           CAST(count(*) AS BIGINT) AS n, round_even({MEAN_LAT}, 6) AS avg_latency_ms,
           round_even(max(latency_ms), 6) AS max_latency_ms
    FROM telemetry GROUP BY time_bucket(INTERVAL 1 HOUR, ts), event_type""", "telemetry"))
def q_stream_turn_metrics(spark, sf_dir):
    out = SM.run_available(SM.turn_metrics(SM.telemetry_stream(spark, sf_dir)), spark, "turn_metrics",
                           open_rows=SM.open_turn_metrics)
    return finalize(out)


@query("stream_attempt_outcomes", with_views(f"""
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, state,
           CAST(count(*) AS BIGINT) AS n
    FROM (SELECT DISTINCT ON (request_id, attempt) * FROM telemetry ORDER BY request_id, attempt, ts) t
    GROUP BY time_bucket(INTERVAL 1 HOUR, ts), state""", "telemetry"))
def q_stream_attempt_outcomes(spark, sf_dir):
    return SM.run_available(SM.attempt_outcomes(SM.telemetry_stream(spark, sf_dir)), spark,
                            "attempt_outcomes", open_rows=SM.open_attempt_outcomes)


@query("stream_session_totals", with_views(f"""
    , flagged AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                               OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE
                          THEN 1 ELSE 0 END AS new_s FROM telemetry),
    sess AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM flagged)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
           strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end,
           CAST(count(*) AS BIGINT) AS n_events,
           round_even(CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / 10.0, 6) AS total_latency_ms
    FROM sess GROUP BY user_id, sid""", "telemetry"))
def q_stream_session_totals(spark, sf_dir):
    out = SM.run_available(SM.session_totals(SM.telemetry_stream(spark, sf_dir)), spark,
                           "session_totals", open_rows=SM.open_session_totals)
    return finalize(out)


@query("stream_history_state", with_views("""
    SELECT h.conv_id, h.turn, CAST(h.n_history AS BIGINT) AS n_history,
           CAST((SELECT count(*) FROM conversations c WHERE c.conv_id = h.conv_id AND c.role = 'assistant'
                 AND c.turn < h.turn) AS BIGINT) AS step
    FROM hist h""", "hist"))
def q_stream_history_state(spark, sf_dir):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SM.ROCKSDB)
    turns = FX.turns_from(SM.stream_table(spark, sf_dir, "conversations"))
    return SM.run_available(SM.history_state(turns), spark, "history_state",
                            open_rows=SM.open_history, state_vars=("waiting", "counters"))


@query("stream_gate_alerts", with_views(f"""
    SELECT 'avg_latency_ms' AS gate, round_even({MEAN_LAT}, 6) AS actual, CAST(8000.0 AS DOUBLE) AS threshold,
           {MEAN_LAT} <= 8000.0 AS passed, CAST(count(*) AS BIGINT) AS n_rows FROM telemetry
    UNION ALL
    SELECT 'error_rate', round_even(avg(CAST(state = 'FAILED' AS DOUBLE)), 6), CAST(0.25 AS DOUBLE),
           avg(CAST(state = 'FAILED' AS DOUBLE)) <= 0.25, CAST(count(*) AS BIGINT) FROM telemetry""", "telemetry"))
def q_stream_gate_alerts(spark, sf_dir):
    out = SM.run_available(SM.telemetry_stream(spark, sf_dir), spark, "gate_alerts",
                           foreach_batch=SM.gate_alert_writer())
    return finalize(out.select("gate", "actual", "threshold", "passed", "n_rows"))
