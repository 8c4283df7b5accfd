"""Vector pooling and exact cosine top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.sources.materialize import checkpointed


def mean_pool_long(df: DataFrame, key: str, vec: str, mask: str | None = None) -> DataFrame:
    """Per key and position, the mean of the vectors' components (rows whose
    mask is false — padding — are excluded).  posexplode + groupBy: partial
    aggregation per (key, pos), so a hot key is combined map-side."""
    x = df.select(key, F.posexplode(vec).alias("pos", "v"),
                  *( [F.col(mask).alias("_m")] if mask else []))
    if mask:
        x = x.where(F.col("_m"))
    return x.groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("mean"))


def mean_pool(df: DataFrame, key: str, vec: str, mask: str | None = None) -> DataFrame:
    """One pooled vector per key (array ordered by position; dim-bounded)."""
    long = mean_pool_long(df, key, vec, mask)
    return long.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))),
                                             lambda s: s["mean"]).alias("pooled"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def normalize(v: Column) -> Column:
    n = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x.cast("double") / n)


# --- exact top-k by pruned search -----------------------------------------------------
#
# Vectors are scaled to length 1, so the largest cosine is the smallest chord
# distance, which obeys the triangle inequality.  Every row lies in the ball
# of its nearest pivot, at a known distance from it; a ball is cut into rings
# by that distance and rings into blocks of bounded size.  With t a bound on a
# query's k-th smallest distance, a row at distance e from a pivot that the
# query is d away from can be among its best k only if |d - e| <= t.

SLACK = 1e-7   # rounding of distances, well above double precision


def directions(df: DataFrame, id_col: str, vec: str, dim: int | None = None) -> DataFrame:
    """(id, v: unit array<double>) of the rows that have a direction: vectors
    that are NULL, zero, hold a NULL or non-finite component, or have another
    length than ``dim`` are left out."""
    x = df.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    # the largest component is taken out first: squares of very large or small ones would not be finite
    x = x.where(F.size("v") > 0).withColumn("top", F.array_max(F.transform("v", F.abs)))
    x = x.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c)) & (F.col("top") > 0)
                & (F.col("top") < float("inf")))
    if dim is not None:
        x = x.where(F.size("v") == dim)
    return x.select("id", normalize(F.transform("v", lambda c: c / F.col("top"))).alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _chord(score: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * score))


def choose_pivots(rows: DataFrame, n: int, sample_rows: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, sample): a bounded sample of distinct vectors by hash, and of
    it the vectors that are farthest from those chosen before them."""
    picked = (rows.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(sample_rows).toArrow())
    sample = np.unique(_matrix(picked.column("v"), dim), axis=0) if picked.num_rows else np.empty((0, dim))
    if not len(sample):
        return sample, sample
    chosen, far = [0], _chord(sample @ sample[0])
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _chord(sample @ sample[chosen[-1]]))
    return sample[chosen], sample


@dataclass(frozen=True)
class TopK:
    """``rows``: qid, id, score, rank.  ``scored``: pairs whose score is
    computed, per visit of a query to a block."""
    rows: DataFrame
    scored: DataFrame
    n_rows: int
    queries: DataFrame

    def share_scored(self) -> float:
        """Share of all (query, row) pairs whose score is computed."""
        n = self.scored.agg(F.sum("pairs")).first()[0] or 0
        return n / max(1, self.n_rows * self.queries.count())


def _usual_dim(df: DataFrame, vec: str) -> tuple[int, int]:
    """(most frequent length of the vectors, ties: the longest; rows of it)."""
    best = (df.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("d")).count()
            .orderBy(F.desc("count"), F.desc("d")).first())
    return (best["d"], best["count"]) if best else (0, 0)


MAX_PIVOTS, MAX_RINGS = 256, 256   # bound what is broadcast; larger rings are cut into parts


def search_topk(table: DataFrame, id_col: str, vec: str, queries: DataFrame, qid: str, qvec: str, k: int,
                sample_rows: int = 4096, block_rows: int = 8192, block_queries: int = 1024,
                pivots: int | None = None) -> TopK:
    """Exact cosine top-k of every query vector against the table.

    1. Pivots come from a bounded sample (``sample_rows``); every row is put
       into a block: ball, ring (equal counts by distance), part (hash of the
       id where a ring is still too large).
    2. A query's first bound is its k-th best in the sample; its own block,
       the one with the smallest gap to it, improves that bound.
    3. It visits the blocks that its bound does not exclude, and there the
       rows that it does not exclude.  At most k rows per (query, block) come
       back and are ranked (``row_number <= k``, a WindowGroupLimit).

    Ties break on the row id.  The vectors' length is the table's most
    frequent one; rows and queries without a direction (see
    :func:`directions`) take no part, such a query has no rows.  Query ids
    are unique but for repeated rows, which count once.  Rows travel once per
    block of queries that asks for their block; only pivots, the sample and
    the rings' edges (at most ``MAX_PIVOTS * MAX_RINGS``) are broadcast."""
    spark = table.sparkSession
    dim, n_rows = _usual_dim(table, vec)
    rows = directions(table, id_col, vec, dim)
    asked = directions(queries, qid, qvec, dim).withColumnRenamed("id", "qid").distinct()
    id_type, q_type = rows.schema["id"].dataType, asked.schema["qid"].dataType
    n_pivots = pivots or min(MAX_PIVOTS, max(1, round(math.sqrt(n_rows) / 4)))
    centres, sample = choose_pivots(rows, n_pivots, sample_rows, dim)
    if not len(centres):
        none = asked.where("false").select("qid", F.lit(None).cast(id_type).alias("id"),
                                           F.lit(None).cast("double").alias("score"))
        return TopK(none.withColumn("rank", F.lit(0)), none.select(F.lit(0).alias("pairs")), 0, asked)
    vector = T.ArrayType(T.DoubleType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _chord(_matrix(batch.column("v"), dim) @ model.value[0].T)
            ball = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(ball.astype(np.int32)),
                 pa.array(np.take_along_axis(d, ball[:, None], 1).ravel())], ["id", "v", "ball", "dist"])

    model = spark.sparkContext.broadcast((centres, sample))  # at most sample_rows vectors
    placed = checkpointed(rows.mapInArrow(place, T.StructType([
        T.StructField("id", id_type), T.StructField("v", vector), T.StructField("ball", T.IntegerType()),
        T.StructField("dist", T.DoubleType())])), "topk-placed")
    # rings: a ball's distances cut at approximate percentiles
    n_rings = min(MAX_RINGS, max(1, math.ceil(4 * n_rows / block_rows / len(centres))))
    cuts = placed.groupBy("ball").agg(F.percentile_approx(
        "dist", [i / n_rings for i in range(1, n_rings)] or [1.0], 100 * n_rings).alias("cuts"))
    placed = placed.join(F.broadcast(cuts), "ball").withColumn("ring", F.size(F.filter(
        "cuts", lambda c: c < F.col("dist")))).drop("cuts")  # one row per pivot, MAX_RINGS cuts each
    rings = (placed.groupBy("ball", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist"), F.max("dist"))
             .orderBy("ball", "ring").toArrow())
    ball, ring, n, low, high = (c.to_numpy() for c in rings.columns)
    parts = -(-n // block_rows)
    edges = spark.sparkContext.broadcast((ball, ring, parts, low, high))
    parts_of = F.broadcast(spark.createDataFrame(list(zip(ball.tolist(), ring.tolist(), parts.tolist())),
                                                 "ball int, ring int, parts int"))
    placed = placed.join(parts_of, ["ball", "ring"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, s = model.value
        ball, ring, parts, low, high = edges.value
        for batch in batches:
            q = _matrix(batch.column("v"), dim)
            score = q @ s.T
            bound = (_chord(np.partition(score, -k, axis=1)[:, -k]) if len(s) >= k else np.full(len(q), 2.0)) + SLACK
            found: list[tuple] = []   # (query, places of its blocks, distances, gaps, own block)
            held = 0
            for i, to_pivots in enumerate(_chord(q @ c.T)):
                d = to_pivots[ball]
                gap = np.maximum(np.maximum(low - d, d - high), 0.0)
                at = np.flatnonzero(gap <= bound[i])
                home = at[np.lexsort((d[at], gap[at]))[0]]
                found.append((np.full(len(at), i), at, d[at], gap[at], at == home))
                held += len(at)
                if held >= 1 << 16 or i == len(q) - 1:
                    query, at, d, gap, home = (np.concatenate(x) for x in zip(*found))
                    found, held = [], 0
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("qid").take(pa.array(query)),
                         *(pa.array(x[at].astype(np.int32)) for x in (ball, ring, parts)), pa.array(d), pa.array(gap),
                         pa.array(bound[query]), pa.array(home)],
                        ["qid", "ball", "ring", "parts", "d", "gap", "bound", "home"])

    visits = checkpointed(asked.mapInArrow(aim, T.StructType([
        T.StructField("qid", q_type), *(T.StructField(c, T.IntegerType()) for c in ("ball", "ring", "parts")),
        *(T.StructField(c, T.DoubleType()) for c in ("d", "gap", "bound")), T.StructField("home", T.BooleanType())])),
        "topk-visits")
    first = checkpointed(_score(placed, visits.where("home"), asked, k, dim, block_queries, id_type, q_type), "topk-first")
    # the k-th best chord of the own block, where it holds k rows
    kth = first.where("score is not null").groupBy("qid").agg(F.sort_array(F.collect_list("score"), False).alias("s"))
    kth = kth.where(F.size("s") >= k).select("qid", (F.sqrt(F.greatest(
        F.lit(0.0), 2 - 2 * F.element_at("s", k))) + SLACK).alias("t"))
    rest = (visits.where("not home").join(kth, "qid", "left")
            .withColumn("bound", F.least("bound", F.coalesce("t", "bound"))).where("gap <= bound"))
    found = first.union(_score(placed, rest, asked, k, dim, block_queries, id_type, q_type))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    best = (found.where("score is not null").select("qid", "id", "score")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))
    return TopK(best, found.select("pairs"), n_rows, asked)


def _score(placed: DataFrame, visits: DataFrame, q_vectors: DataFrame, k: int, dim: int, block_queries: int,
           id_type: T.DataType, q_type: T.DataType) -> DataFrame:
    """qid, id, score of the best k rows of every visited block that the
    query's bound does not exclude; ``pairs`` counts the pairs scored in a
    visit, on its first row (which has no score where nothing was left)."""
    parts = visits.select("qid", "ball", "ring", "d", "bound", F.explode(F.sequence(
        F.lit(0), F.col("parts") - 1)).alias("part"))
    sizes = parts.groupBy("ball", "ring", "part").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("q_parts"))
    key = ["ball", "ring", "part", "q_part"]
    asking = parts.join(sizes, ["ball", "ring", "part"]).withColumn(
        "q_part", F.pmod(F.xxhash64("qid"), F.col("q_parts")).cast("int")).drop("q_parts").join(q_vectors, "qid")
    asked_rows = placed.join(sizes, ["ball", "ring", "part"]).withColumn(
        "q_part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1))).drop("q_parts")
    schema = T.StructType([T.StructField("qid", q_type), T.StructField("id", id_type),
                           T.StructField("score", T.DoubleType()), T.StructField("pairs", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def best(block: pa.Table, q: pa.Table) -> pa.Table:
        if not block.num_rows or not q.num_rows:
            return arrow.empty_table()
        # by distance, so that the rows a query may need are one slice
        block = block.sort_by([("dist", "ascending"), ("id", "ascending")])
        x, dist = _matrix(block.column("v"), dim), block.column("dist").to_numpy()
        order = np.empty(block.num_rows, np.int64)   # place of each row by id, for ties
        order[pc.sort_indices(block.column("id")).to_numpy()] = np.arange(block.num_rows)
        v, d, bound = _matrix(q.column("v"), dim), q.column("d").to_numpy(), q.column("bound").to_numpy()
        low = np.searchsorted(dist, d - bound - SLACK, side="left")
        high = np.searchsorted(dist, d + bound + SLACK, side="right")
        q_at, row_at, scores, pairs = [], [], [], []
        for i in range(len(v)):
            a, b = low[i], high[i]
            score = (x[a:b] * v[i]).sum(1)   # row by row alike, so equal vectors tie wherever they lie
            if b - a > k:
                least = np.partition(score, -k)[-k]
                keep = np.flatnonzero(score >= least)   # ties at the edge stay, then the order decides
            else:
                keep = np.arange(b - a)
            keep = keep[np.lexsort((order[a:b][keep], -score[keep]))][:k]
            q_at += [i] * max(1, len(keep))
            row_at += (keep + a).tolist() or [None]
            scores += score[keep].tolist() or [None]
            pairs += [int(b - a)] + [0] * (max(1, len(keep)) - 1)
        return pa.table([q.column("qid").take(pa.array(q_at)), block.column("id").take(pa.array(row_at, pa.int64())),
                         pa.array(scores, pa.float64()), pa.array(pairs, pa.int64())], schema=arrow)

    return asked_rows.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(best, schema)


def cosine_topk(table: DataFrame, id_col: str, vec: str, queries: DataFrame, qid: str,
                qvec: str, k: int, **options) -> DataFrame:
    """qid, id, score, rank of :func:`search_topk`."""
    return search_topk(table, id_col, vec, queries, qid, qvec, k, **options).rows
