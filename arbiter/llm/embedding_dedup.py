"""Near-duplicate embeddings by product quantisation.

Index: k-means cells (coarse inverted lists) and, per subspace of the
residual, a codebook; both are fitted on the driver from a bounded hash
sample of distinct vectors (``sample_rows``), everything else covers all
vectors.  A vector is stored in its nearest cell with its residual code and
the exact length of what the code misses.

Search: a vector probes every cell that can hold a partner.  Unit vectors
within distance ``r`` (cosine >= threshold) of ``x`` lie in cell ``j`` only
if, for x's own cell ``i``, ``d(x,j)^2 - d(x,i)^2 <= 2 r |c_i - c_j|``: the
bisector between the cells is no further from x than r.  Asymmetric table
look-ups give the distance to the decoded member; a pair is dropped only if
that exceeds ``r`` plus the member's own quantisation error.  Both bounds are
exact, so no link is lost; the cosine of what is left is computed in double
precision.  In many dimensions a partner hardly ever lies straight towards a
bisector; ``margin`` below 1 shrinks the radius of that test (and only of
that), which cuts probes at a small, measurable loss.  The query keeps 1.

Equal vectors are collapsed before the search.  Lists and probes are cut into
blocks of bounded size; a block returns link counts per vector and a spanning
forest of its links, never the pairs.

Rows are numbered for the search, so ids only name the result.

Defined results: a vector that is null, zero or has null or non-finite
components, or whose label is null, links with nothing; labels of any type
are compared as they are; vectors of different lengths never link; repeated
rows, and other vectors under one id, are separate vectors; a null id is the
smallest of no group, so only a group that has no other has a null
``component_id`` (its rows are all ``kept``); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.llm.common import lean, parts_for, prepare, written
from arbiter.llm.components import connected_components, local_labels

def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)[0]
        size = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        used = size > 0
        centres[used] = sums[used] / size[used, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and all squared distances."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    return d.argmin(1), d


@dataclass
class ProductQuantiser:
    centres: np.ndarray      # cells x dim
    books: np.ndarray        # subspaces x codes x width

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, subspaces: int = 8, codes: int = 64, seed: int = 1) -> ProductQuantiser:
        centres = _kmeans(x, max(1, min(cells, len(x))), 12, seed)
        rest = x - centres[_nearest(x, centres)[0]]
        width = x.shape[1] // subspaces
        books = np.stack([_kmeans(rest[:, s * width:(s + 1) * width], min(codes, len(x)), 8, seed + s)
                          for s in range(subspaces)])
        return cls(centres, books)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, code, length the code misses, squared distances to cells)."""
        cell, d = _nearest(x, self.centres)
        rest = x - self.centres[cell]
        parts = rest.reshape(len(x), len(self.books), -1)
        code = np.stack([_nearest(parts[:, s], b)[0] for s, b in enumerate(self.books)], axis=1).astype(np.uint8)
        decoded = np.concatenate([b[code[:, s]] for s, b in enumerate(self.books)], axis=1)
        return cell, code, np.linalg.norm(rest - decoded, axis=1), d

    def probes(self, cell: np.ndarray, d: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that can hold a partner within radius."""
        gap = np.linalg.norm(self.centres[:, None] - self.centres[None], axis=2)
        own = d[np.arange(len(d)), cell][:, None]
        return np.nonzero(d - own <= 2 * radius * gap[cell] + 1e-9)

    def adc(self, x: np.ndarray, cell: int, code: np.ndarray) -> np.ndarray:
        """Distances of queries to the decoded members of one cell."""
        rest = (x - self.centres[cell]).reshape(len(x), len(self.books), -1)
        total = np.zeros((len(x), len(code)))
        for s, book in enumerate(self.books):
            total += _nearest(rest[:, s], book)[1][:, code[:, s]]
        return np.sqrt(np.maximum(total, 0))


def vectors(df: DataFrame) -> DataFrame:
    """vec_id, label, dim and unit vector (little-endian doubles) of every
    vector that can link; the norm is taken after scaling by the largest
    component, so no square over- or underflows."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]]).add("dim", "integer").add("vec", "binary")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            out: list[bytes] = []
            for i, (label, v) in enumerate(zip(batch.column(1), batch.column(2))):
                if not label.is_valid or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    continue
                x = x / top
                at.append(i)
                out.append((x / np.sqrt((x * x).sum())).astype("<f8").tobytes())
            some = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(some), batch.column(1).take(some),
                 pa.array([len(v) // 8 for v in out], pa.int32()), pa.array(out, pa.binary())], schema.names)

    return rows.mapInArrow(lean(unit), schema)


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a binary column as doubles, padded with zeros to ``width``."""
    rows = [np.frombuffer(v, "<f8") for v in column.to_pylist()]
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def fit_index(distinct: DataFrame, sample_rows: int = 8192, rows_per_cell: int = 1024, max_cells: int = 1024,
              subspaces: int = 8) -> tuple[ProductQuantiser, int] | None:
    """Quantiser from at most about ``sample_rows`` vectors (chosen by a hash
    of the vector), and the padded width; None if there are no vectors.  Lists
    are kept per label, so the largest label sets the number of cells."""
    by_label = distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"))
    n, largest, widest = by_label.agg(F.sum("n"), F.max("n"), F.max("dim")).first()
    if not n:
        return None
    width = -(-widest // subspaces) * subspaces
    share = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(min(1.0, sample_rows / n) * (1 << 30))
    rows = distinct.where(share).select("vec").toArrow()
    if not rows.num_rows:
        rows = distinct.select("vec").limit(1).toArrow()
    x = _matrix(rows.sort_by("vec").column("vec"), width)
    return ProductQuantiser.fit(x, min(max_cells, parts_for(largest, rows_per_cell)), subspaces), width


def link_blocks(distinct: DataFrame, index: ProductQuantiser, width: int, threshold: float,
                block_rows: int = 1024, margin: float = 1.0) -> DataFrame:
    """(rep, links, root): link counts of vectors and forests, block by block."""
    radius = math.sqrt(2 - 2 * threshold) + 1e-9
    model = distinct.sparkSession.sparkContext.broadcast(index)
    placed = T.StructType([*(distinct.schema[c] for c in ("rep", "copies", "label", "dim"))]).add("cell", "integer").add(
        "query", "boolean").add("code", "binary").add("miss", "double").add("vec", "binary")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vec"), width)
            cell, code, miss, d = model.value.encode(x)
            member = np.arange(len(x))
            row, probe = model.value.probes(cell, d, margin * radius)
            at = np.concatenate((member, row))
            query = np.concatenate((np.zeros(len(x), bool), np.ones(len(row), bool)))
            codes = pa.array([None if q else code[i].tobytes() for i, q in zip(at, query)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at)) for c in ("rep", "copies", "label", "dim")),
                 pa.array(np.concatenate((cell, probe)).astype(np.int32)), pa.array(query), codes,
                 pa.array(miss[at]), batch.column("vec").take(pa.array(at))],
                placed.names)

    key = ["label", "dim", "cell"]
    rows = written(distinct.select("rep", "copies", "label", "dim", "vec").mapInArrow(lean(place), placed), "placed")
    sizes = rows.groupBy(*key).agg(
        F.ceil(F.sum(F.col("query").cast("long")) / block_rows).cast("int").alias("q_parts"),
        F.ceil(F.sum((~F.col("query")).cast("long")) / block_rows).cast("int").alias("m_parts")).where("m_parts > 0")
    parts = F.when(F.col("query"), F.col("q_parts")).otherwise(F.col("m_parts"))
    own = F.pmod(F.xxhash64("rep"), parts).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("query"), F.col("m_parts")).otherwise(F.col("q_parts")) - 1)
    dealt = (rows.join(sizes, key).withColumn("own", own).withColumn("other", F.explode(other))
             .withColumn("q_part", F.when(F.col("query"), F.col("own")).otherwise(F.col("other")))
             .withColumn("m_part", F.when(F.col("query"), F.col("other")).otherwise(F.col("own"))))

    def search(block: pa.Table) -> pa.Table:
        query = block.column("query").to_numpy()
        q, m = block.filter(pa.array(query)), block.filter(pa.array(~query))
        none = pa.table({c: pa.array([], pa.int64()) for c in ("rep", "links", "root")})
        if not q.num_rows or not m.num_rows:
            return none
        x, y = _matrix(q.column("vec"), width), _matrix(m.column("vec"), width)
        q_ids, m_ids = q.column("rep").to_numpy(), m.column("rep").to_numpy()
        copies, miss = m.column("copies").to_numpy(), m.column("miss").to_numpy()
        code = np.frombuffer(b"".join(m.column("code").to_pylist()), np.uint8).reshape(len(m_ids), -1)
        near = model.value.adc(x, block.column("cell")[0].as_py(), code) <= radius + miss[None, :] + 1e-9
        a, b = np.nonzero(near & (q_ids[:, None] != m_ids[None, :]))
        hits = [a[:0]]
        for s in range(0, len(a), 1 << 14):
            i, j = a[s:s + (1 << 14)], b[s:s + (1 << 14)]
            hits.append(s + np.flatnonzero(np.einsum("ij,ij->i", x[i], y[j]) >= threshold))
        hits = np.concatenate(hits)
        a, b = a[hits], b[hits]
        ids, at = np.unique(np.concatenate((q_ids, m_ids)), return_inverse=True)
        label = local_labels(len(ids), at[a], at[len(q_ids) + b])
        counts = np.bincount(at[a], copies[b], len(ids)).astype(np.int64)
        some = np.flatnonzero((counts > 0) | (label != np.arange(len(ids))))
        return pa.table({"rep": ids[some], "links": counts[some], "root": ids[label[some]]})

    return dealt.groupBy(*key, "q_part", "m_part").applyInArrow(search, "rep long, links long, root long")


def near_duplicates(df: DataFrame, threshold: float = 0.98, sample_rows: int = 8192, margin: float = 1.0) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df``
    (vec_id, label, embedding)."""
    prepare(df.sparkSession)
    rows = written(vectors(df), "vectors")
    same = ["label", "dim", "vec"]
    distinct = written(rows.groupBy(*same).agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    # rows that can't link come back from the table itself
    loose = _unlinkable(df).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                   F.col("vec_id").alias("component_id"))
    out = loose
    fitted = fit_index(distinct, sample_rows)
    if fitted is not None:
        found = written(link_blocks(distinct, *fitted, threshold, margin=margin), "links")
        n_links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        groups = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        lowest = (groups.join(distinct.select("rep", "low"), F.col("node") == F.col("rep"))
                  .groupBy("component").agg(F.min("low").alias("lowest")))
        named = groups.join(lowest, "component").select("node", "lowest", F.lit(True).alias("grouped"))
        per_rep = (distinct.join(n_links, "rep", "left")
                   .join(named, F.col("rep") == F.col("node"), "left")
                   .select(*same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                           F.when(F.col("grouped"), F.col("lowest")).otherwise(F.col("low")).alias("component_id")))
        out = rows.join(per_rep, same).select("vec_id", "n_links", "component_id").union(loose)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _unlinkable(df: DataFrame) -> DataFrame:
    """vec_id of the rows that :func:`vectors` leaves out."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
              & F.exists(e, lambda v: v != 0))
    return df.where(~F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"))
