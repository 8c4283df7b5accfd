"""Leaderboard, best candidate, latest version, seeded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbiter import defaults as D


def leaderboard(summary: DataFrame, order: str = "ord") -> DataFrame:
    """Comparison table of all templates in config order (no collect)."""
    return summary.orderBy(order)


def best_candidate(summary: DataFrame, threshold: float = D.SCORE_THRESHOLD,
                   partition_cols=(), score: str = "composite",
                   tie: str = "ord") -> DataFrame:
    """Top-1 by composite (ties keep config order), kept only when it clears
    the threshold.  Per project with partition_cols; the window carries a
    rank limit, so Spark plans a WindowGroupLimit before the shuffle."""
    order = [F.col(score).desc(), F.col(tie).asc()]
    if not partition_cols:
        # global form: TakeOrderedAndProject (per-partition top-1, then merge)
        top = summary.orderBy(*order).limit(1)
        return top.where(F.col(score) >= F.lit(float(threshold)))
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    ranked = summary.withColumn("_rk", F.row_number().over(w))
    return ranked.where((F.col("_rk") == 1) & (F.col(score) >= F.lit(float(threshold)))).drop("_rk")


def latest_version(registered: DataFrame, model: str = "model",
                   version: str = "version") -> DataFrame:
    """Highest version per model compared as integers (not as text)."""
    return registered.groupBy(model).agg(
        F.max(F.col(version).cast("bigint")).alias("latest_version"))


def seeded_sample(df: DataFrame, key: str, k: int, seed: str = "s",
                  partition_cols=()) -> DataFrame:
    """k rows without replacement per partition group, chosen by the md5 of
    seed||key, so both sides of a comparison draw the same sample and the
    choice is stable under repartitioning.  row_number <= k is planned as a
    WindowGroupLimit: each map task ships at most k rows per group."""
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    if not partition_cols:
        # one global sample: TakeOrderedAndProject (per-partition top-k, then merge)
        return df.orderBy(h, F.col(key)).limit(k)
    w = Window.partitionBy(*partition_cols).orderBy(h, F.col(key))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def hash_bucket(key, seed: str = "s", buckets: int = 100):
    """Stable bucket in [0, buckets) from the first 8 hex digits of md5."""
    hexpart = F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string")
                                         if isinstance(key, str) else key)), 1, 8)
    return F.pmod(F.conv(hexpart, 16, 10).cast("bigint"), F.lit(buckets))
