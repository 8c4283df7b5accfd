"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import drop_written, parts_for, written

EDGES_PER_FILE = 20_000


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes, edges a[i] - b[i]."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        # hook the roots of both ends below the smaller label, then shorten
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, shorter := label[label]):
            label = shorter


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), where component
    is the smallest node reachable.

    Alternating large-star and small-star rounds: every round connects each
    node's larger neighbours (then its smaller ones) to its smallest one, so
    chains halve and the edges end as stars.  A round is grouped minima and
    joins; neighbours are never gathered.  Its edges are written to the shared
    folder, so lineage stays short and a lost executor costs one round."""
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    now = written(edges.where("a <> b").select(hi, lo).distinct(), "edges")

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    seen = state(now)
    while seen[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi")
                 .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").where("hi <> lo").distinct())
        # a round has no more edges than twice the last one: few files for few edges
        after = written(small.coalesce(parts_for(seen[0], EDGES_PER_FILE)), "edges")
        drop_written(now)
        now, before, seen = after, seen, state(after)
        if seen == before:
            break
    roots = now.select("lo").distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots.select("lo", "lo"))
