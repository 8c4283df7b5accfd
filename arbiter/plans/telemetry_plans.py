"""Telemetry queries: traffic split, ops metrics, drift, A/B by arm."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbiter.operators import telemetry as TM
from arbiter.plans.catalog import finalize, query
from arbiter.plans.oracle_views import register_view, with_views
from arbiter.sources import fixtures as FX

register_view("telemetry", (), """
    SELECT event_id, ts, user_id, event_type, event_id // 3 AS request_id, event_id % 3 AS attempt,
           CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RETRYING' ELSE 'EXECUTED' END AS state,
           round(value * 40, 1) AS latency_ms
    FROM events""")
ARM_SQL = ("CASE WHEN ('0x' || substr(md5('arm' || CAST(request_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 10 "
           "THEN 'challenger' ELSE 'champion' END")
MEAN_LAT = ("CAST(sum(CAST(round(latency_ms * 10) AS BIGINT)) AS DOUBLE) / "
            "CAST(10 * count(latency_ms) AS DOUBLE)")


def tel(spark, sf_dir):
    return FX.telemetry(spark, sf_dir)


@query("traffic_split", with_views(f"""
    SELECT request_id, {ARM_SQL} AS arm, CAST(count(*) AS BIGINT) AS n_events
    FROM telemetry GROUP BY request_id""", "telemetry"))
def q_traffic_split(spark, sf_dir):
    t = tel(spark, sf_dir)
    return t.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_events")).select(
        "request_id", TM.traffic_arm("request_id").alias("arm"), "n_events")


@query("ops_metrics", with_views(f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS n,
           round_even(avg(CAST(state = 'FAILED' AS DOUBLE)), 6) AS error_share,
           round_even(avg(CAST(state = 'RETRYING' AS DOUBLE)), 6) AS retry_share,
           round_even({MEAN_LAT}, 6) AS avg_latency_ms,
           round_even(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
           round_even(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms
    FROM telemetry GROUP BY 1, 2""", "telemetry"))
def q_ops_metrics(spark, sf_dir):
    return finalize(TM.ops_metrics(tel(spark, sf_dir)).withColumn("n", F.col("n").cast("bigint")))


# A type that begins after the first week: a tenth of the users' views from
# the ninth day on are previews.
def _drift_sql(bins: str) -> str:
    return with_views(f"""
    , z AS (SELECT CASE WHEN event_type = 'view' AND user_id % 10 = 3 AND
                             ts >= (SELECT min(ts) FROM telemetry) + INTERVAL 8 DAY THEN 'preview' ELSE event_type END
                   AS event_type, latency_ms,
                   CAST(floor(CAST(epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM telemetry) AS DOUBLE)
                              / CAST(604800000000 AS DOUBLE)) AS INTEGER) AS period FROM telemetry),
    {bins},
    counts AS (SELECT event_type, period, bin, count(*) AS c FROM x GROUP BY ALL),
    totals AS (SELECT event_type, period, sum(c) AS tot FROM counts GROUP BY ALL),
    grid AS (SELECT t.event_type, t.period, CAST(b.range AS INTEGER) AS bin FROM totals t, range(0, 10) b),
    full_ AS (SELECT g.event_type, g.period, g.bin,
                     greatest(coalesce(CAST(c.c AS DOUBLE) / CAST(t.tot AS DOUBLE), 0.0), 1e-6) AS p
              FROM grid g JOIN totals t ON t.event_type = g.event_type AND t.period = g.period
              LEFT JOIN counts c ON c.event_type = g.event_type AND c.period = g.period AND c.bin = g.bin)
    SELECT event_type, period, round_even(psi, 6) AS psi, psi > 0.2 AS alert FROM (
      SELECT cur.event_type, cur.period,
             list_reduce(list((cur.p - coalesce(r.p, 1e-6)) * ln(cur.p / coalesce(r.p, 1e-6)) ORDER BY cur.bin),
                         lambda a, b: a + b) AS psi
      FROM full_ cur LEFT JOIN full_ r ON r.event_type = cur.event_type AND r.bin = cur.bin AND r.period = 0
      WHERE cur.period > 0 GROUP BY cur.event_type, cur.period) s""", "telemetry")


def with_previews(spark, sf_dir):
    t = tel(spark, sf_dir)
    t0 = t.agg(F.min("ts")).first()[0]
    new = (F.col("event_type") == "view") & (F.col("user_id") % 10 == 3) & (
        F.col("ts") >= F.lit(t0) + F.expr("INTERVAL 8 DAY"))
    return t.withColumn("event_type", F.when(new, "preview").otherwise(F.col("event_type")))


@query("drift_report", _drift_sql("""
    x AS (SELECT event_type, period, CAST(least(floor(latency_ms / 1000.0), 9) AS INTEGER) AS bin FROM z)"""))
def q_drift_report(spark, sf_dir):
    return finalize(TM.drift_report(with_previews(spark, sf_dir)))


@query("drift_deciles", _drift_sql("""
    edges AS (SELECT event_type, quantile_disc(latency_ms, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
              FROM z WHERE period = 0 GROUP BY event_type),
    pooled AS (SELECT quantile_disc(latency_ms, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
               FROM z WHERE period = 0),
    x AS (SELECT z.event_type, period, CAST(len(list_filter(coalesce(edges.e, pooled.e), lambda q: q < latency_ms))
                                            AS INTEGER) AS bin
          FROM z LEFT JOIN edges ON edges.event_type = z.event_type, pooled)"""))
def q_drift_deciles(spark, sf_dir):
    # the accuracy is above the rows of the first period here, which makes the edges exact
    return finalize(TM.drift_report(with_previews(spark, sf_dir), width=None, accuracy=1_000_000))


@query("ab_metrics_by_arm", with_views(f"""
    , arms AS (SELECT {ARM_SQL} AS arm, state, latency_ms FROM telemetry),
    w AS (SELECT arm, CAST(count(*) AS DOUBLE) AS n, avg(CAST(state = 'FAILED' AS DOUBLE)) AS error_share,
                 {MEAN_LAT} AS avg_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms
          FROM arms GROUP BY arm),
    l AS (UNPIVOT w ON n, error_share, avg_latency_ms, p95_latency_ms INTO NAME metric VALUE value)
    SELECT metric, round_even(max(CASE WHEN arm = 'champion' THEN value END), 6) AS champion,
           round_even(max(CASE WHEN arm = 'challenger' THEN value END), 6) AS challenger,
           round_even(max(CASE WHEN arm = 'challenger' THEN value END)
                      - max(CASE WHEN arm = 'champion' THEN value END), 6) + 0.0 AS diff
    FROM l GROUP BY metric""", "telemetry"))
def q_ab_metrics_by_arm(spark, sf_dir):
    return finalize(TM.ab_metrics(tel(spark, sf_dir)))


@query("attempt_final_state", with_views("""
    SELECT request_id, arg_max(state, attempt) AS final_state, CAST(count(*) AS BIGINT) AS attempts
    FROM telemetry GROUP BY request_id""", "telemetry"))
def q_attempt_final_state(spark, sf_dir):
    return TM.final_attempt_states(tel(spark, sf_dir)).withColumn(
        "attempts", F.col("attempts").cast("bigint"))
