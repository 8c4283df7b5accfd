"""Operational telemetry: traffic split, exact percentiles, ops metrics,
population-stability drift, A/B metrics by arm, retry outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.rules import exact_mean
from arbiter.operators.ranking import hash_bucket


def traffic_arm(key, share_pct: int = D.TRAFFIC_SHARE_PCT, seed: str = "arm") -> Column:
    """Deterministic arm: 'challenger' for the md5 bucket < share_pct."""
    return F.when(hash_bucket(key, seed) < share_pct, F.lit("challenger")).otherwise(F.lit("champion"))


def _percentile_aggs(value: str, ps: dict[str, float]) -> list:
    aggs = []
    for name, p in ps.items():
        pos = F.lit(float(p)) * (F.col("_n") - F.lit(1)).cast("double")
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.min(F.when(F.col("_cum") > lo, F.col(value))).alias(f"_{name}_lo"),
                 F.min(F.when(F.col("_cum") > hi, F.col(value))).alias(f"_{name}_hi"),
                 F.max(pos - lo).alias(f"_{name}_frac")]
    return aggs


def _percentile_cols(ps: dict[str, float]) -> list:
    return [(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_frac")).alias(n)
            for n in ps]


def _cumulate(hist: DataFrame, keys: list[str], value: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return hist.select("*", F.sum("_c").over(w).alias("_cum"),
                       F.sum("_c").over(Window.partitionBy(*keys)).alias("_n"))


def exact_percentiles(df: DataFrame, keys: list[str], value: str,
                      ps: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation percentiles (percentile_cont) per group.

    Instead of buffering every value of a group in one task, values are first
    counted per (group, value) — a partial aggregation — and the ranks are
    read off the cumulative counts of that histogram with a window whose
    partitions hold one row per distinct value."""
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    g = _cumulate(hist, keys, value).groupBy(*keys).agg(*_percentile_aggs(value, ps))
    return g.select(*keys, *_percentile_cols(ps))


def ops_metrics(t: DataFrame) -> DataFrame:
    """Per day and event type: count, error share, retry share, mean latency,
    exact p50/p95 latency — one scan: a (day, type, latency) histogram that
    also carries the state counts, one window over it, one final aggregate."""
    day = t.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    keys = ["day", "event_type"]
    hist = day.groupBy(*keys, "latency_ms").agg(
        F.count(F.lit(1)).alias("_c"),
        F.count_if(F.col("state") == "FAILED").alias("_f"),
        F.count_if(F.col("state") == "RETRYING").alias("_r"),
        F.sum(F.round(F.col("latency_ms") * F.lit(10.0)).cast("bigint")).alias("_l10"))
    ps = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}
    g = _cumulate(hist, keys, "latency_ms").groupBy(*keys).agg(
        F.sum("_c").alias("n"), F.sum("_f").alias("_fs"), F.sum("_r").alias("_rs"),
        F.sum("_l10").alias("_ls"), *_percentile_aggs("latency_ms", ps))
    return g.select(*keys, "n",
                    (F.col("_fs") / F.col("n")).alias("error_share"),
                    (F.col("_rs") / F.col("n")).alias("retry_share"),
                    (F.col("_ls").cast("double") / (F.col("n") * F.lit(10)).cast("double"))
                    .alias("avg_latency_ms"),
                    *_percentile_cols(ps))


def psi_bins(latency, width: float, n_bins: int) -> Column:
    return F.least(F.floor(latency / F.lit(width)), F.lit(n_bins - 1)).cast("int")


def with_period(t: DataFrame, period_days: int) -> DataFrame:
    """``period``: whole periods since the series began."""
    t0 = t.agg(F.min(F.unix_micros("ts"))).first()[0]   # one scalar: the series start
    return t.withColumn("period", F.floor((F.unix_micros("ts") - F.lit(t0)) /
                                          F.lit(period_days * 86400 * 1_000_000)).cast("int"))


def reference_edges(x: DataFrame, metric: str, n_bins: int, accuracy: int) -> DataFrame:
    """(event_type, edges): quantile edges of the metric in the first period
    from one mergeable sketch per type: an edge's rank is off by at most a
    share of 1 / ``accuracy``.  The row without a type holds the edges of all
    types together, for types that the first period does not have."""
    ranks = [i / n_bins for i in range(1, n_bins)]
    first = x.where((F.col("period") == 0) & F.col(metric).isNotNull())
    both = first.select(metric, F.explode(F.array(F.col("event_type"), F.lit(None).cast("string"))).alias("event_type"))
    return both.groupBy("event_type").agg(F.percentile_approx(metric, ranks, accuracy).alias("edges"))


def drift_report(t: DataFrame, metric: str = "latency_ms", width: float | None = 1000.0,
                 n_bins: int = 10, period_days: int = 7, floor: float = D.PSI_FLOOR,
                 alert: float = D.PSI_ALERT, accuracy: int = 10_000) -> DataFrame:
    """Population stability index of the metric's histogram, each later
    period vs the first period, per event type; alert when > 0.2.

    Bins have the fixed ``width``, or, where it is None, edges at the first
    period's quantiles (:func:`reference_edges`; a value equal to an edge is
    below it).  A type that the first period does not have has reference
    shares of 0 in every bin, so its index is that of all its rows being new.
    A NULL metric is in no bin; a type whose period has none but NULLs has
    shares of 0."""
    x = with_period(t, period_days)
    if width is None:
        edges = reference_edges(x, metric, n_bins, accuracy)
        every = edges.where("event_type is null").select(F.col("edges").alias("pooled"))
        x = (x.join(edges.where("event_type is not null"), "event_type", "left").join(F.broadcast(every))
             .withColumn("bin", F.when(F.col(metric).isNotNull(), F.size(F.filter(
                 F.coalesce("edges", "pooled"), lambda e: e < F.col(metric))))))
    else:
        x = x.withColumn("bin", psi_bins(F.col(metric), width, n_bins))
    counts = x.groupBy("event_type", "period", "bin").agg(F.count("bin").alias("c"))
    # one row per (type, period): bin -> count map and total; shares for all
    # bins (floored) as an array ordered by bin
    per = counts.groupBy("event_type", "period").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "c")))).alias("_m"),
        F.sum("c").alias("_tot"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)), lambda b: F.greatest(
        F.coalesce(F.try_divide(F.try_element_at(F.col("_m"), b).cast("double"), F.col("_tot").cast("double")),
                   F.lit(0.0)), F.lit(float(floor))))
    per = per.select("event_type", "period", shares.alias("p"))
    # the reference (first) period's distribution, fetched per type by a window
    ref = F.first(F.when(F.col("period") == 0, F.col("p")), ignorenulls=True).over(
        Window.partitionBy("event_type"))
    none = F.array(*[F.lit(float(floor))] * n_bins)
    cur = per.select("event_type", "period", "p", F.coalesce(ref, none).alias("q")).where(F.col("period") > 0)
    terms = F.zip_with("p", "q", lambda a, b: (a - b) * F.log(a / b))
    psi = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return cur.select("event_type", "period", psi.alias("psi"), (psi > F.lit(alert)).alias("alert"))


def ab_metrics(t: DataFrame, key: str = "request_id") -> DataFrame:
    """Champion vs challenger arm: count, error share, mean and p95 latency,
    and the challenger - champion difference, one row per metric.  One scan:
    an (arm, latency) histogram carries the counts; its window runs over
    distinct latencies only."""
    hist = t.groupBy(traffic_arm(key).alias("arm"), "latency_ms").agg(
        F.count(F.lit(1)).alias("_c"), F.count_if(F.col("state") == "FAILED").alias("_f"))
    l10 = F.round(F.col("latency_ms") * F.lit(10.0)).cast("bigint") * F.col("_c")
    wide = _cumulate(hist, ["arm"], "latency_ms").groupBy("arm").agg(
        F.sum("_c").cast("double").alias("n"), F.sum("_f").alias("_fs"), F.sum(l10).alias("_ls"),
        *_percentile_aggs("latency_ms", {"p95_latency_ms": 0.95}))
    wide = wide.select("arm", "n", (F.col("_fs") / F.col("n")).alias("error_share"),
                       (F.col("_ls").cast("double") / (F.col("n") * F.lit(10)).cast("double")).alias("avg_latency_ms"),
                       *_percentile_cols({"p95_latency_ms": 0.95}))
    metrics = ["n", "error_share", "avg_latency_ms", "p95_latency_ms"]
    long = wide.unpivot(["arm"], metrics, "metric", "value")
    piv = long.groupBy("metric").pivot("arm", ["champion", "challenger"]).agg(F.first("value"))
    return piv.withColumn("diff", F.col("challenger") - F.col("champion"))


def final_attempt_states(t: DataFrame) -> DataFrame:
    """Outcome of each request: state of its last attempt (partial max_by)."""
    return t.groupBy("request_id").agg(F.max_by("state", "attempt").alias("final_state"),
                                       F.count(F.lit(1)).alias("attempts"))
