"""Exact removal of repeated byte strings by blockwise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts
earlier (in a document with a smaller id, or further left in the same one).
Suffixes are compared to that depth only, so the suffix array of the corpus
is needed just where suffixes tie for ``length`` bytes.

1. *Cover sample.*  The positions of a document whose residues modulo ``v``
   lie in a difference cover (a perfect difference set of ``k`` residues,
   v = k^2 - k + 1): for any two suffixes some shift below ``v`` puts both on
   sample positions.  So two suffixes that tie for ``length`` bytes meet at
   sample suffixes that tie for ``length - v + 1`` bytes.  The rank of a
   sample suffix at that depth is needed in one regard only, whether another
   has the same: cells of the sample suffixes are counted corpus-wide.
2. *Long ties are resolved by the sample*: a suffix with no tied sample
   suffix among its next ``v`` positions cannot tie with any other.  What is
   left, the candidates, is stored as intervals of the segment.
3. *Suffix buckets.*  Splitters over the candidates' leading bytes (and, for
   leading bytes that many share, a fingerprint of the rest) cut the order of
   suffixes into shards, and consecutive shards into ``buckets`` buckets.  One
   bucket at a time is gathered and sorted, so keys of one bucket only are on
   disk at once; its result is a bit per distinct string of a segment: an
   earlier segment holds it.

Inside a shard the order is leading bytes, then a 96-bit fingerprint of all
``length`` bytes: equal strings, and only they, stand together.

Defined results: a null text is empty; a document shorter than ``length``
loses nothing; repeated rows are separate documents in the order of their
ids, equal ids by a hash of the text; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.llm import exchange as X
from arbiter.llm.common import drop_written, lean, prepare, written

SAMPLE_SEED, ORDER_SEED, TIE_SEED = 5, 6, 7
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
SIGN = np.uint64(1 << 63)


def difference_cover(length: int) -> tuple[int, list[int]]:
    """(v, residues): the largest perfect difference set with up to eight
    residues whose period leaves at least four tenths of ``length``."""
    for k in (8, 6, 5, 4, 3, 2):
        v = k * k - k + 1
        if v - 1 <= length * 6 // 10 and (found := _perfect([0], set(), k, v)):
            return v, found
    return 1, [0]


def _perfect(chosen: list[int], used: set[int], k: int, v: int) -> list[int] | None:
    if len(chosen) == k:
        return chosen
    for x in range(chosen[-1] + 1, v):
        gaps = {(x - y) % v for y in chosen} | {(y - x) % v for y in chosen}
        if len(gaps) == 2 * len(chosen) and not gaps & used:
            if found := _perfect([*chosen, x], used | gaps, k, v):
                return found
    return None


class Cover:
    """Sample positions of a segment and the candidates they leave."""

    def __init__(self, length: int):
        self.length = length
        self.v, residues = difference_cover(length)
        self.depth = length - self.v + 1
        self.period = np.isin(np.arange(self.v), residues)

    def sample(self, s: X.Segment) -> np.ndarray:
        mark = np.zeros(len(s.bytes), bool)
        longest = max(0, int(s.sizes.max(initial=0)))
        pattern = np.tile(self.period, longest // self.v + 1)
        for a, n in zip(s.starts.tolist(), (s.sizes - self.depth + 1).tolist()):
            if n > 0:
                mark[a:a + n] = pattern[:n]
        return np.flatnonzero(mark)

    def hashes(self, s: X.Segment, at: np.ndarray) -> np.ndarray:
        return X.RollingHash(s.bytes, SAMPLE_SEED)(at, at + self.depth)

    def candidates(self, s: X.Segment, bits: int, answer) -> np.ndarray:
        """(begin, end) of the runs of suffixes that may tie with others."""
        at = self.sample(s)
        order, first, cell = X.cells_of(self.hashes(s, at), bits)
        tied = X.flags_of(answer, (cell >> np.uint64(32)).astype(np.int64))
        hit = at[order[np.repeat(tied, np.diff(first, append=len(order)))]]
        n = len(s.bytes)
        seen = np.zeros(n + self.v + 1, np.int32)
        seen[hit + 1] = 1
        np.cumsum(seen, out=seen)
        may = seen[self.v:n + self.v] > seen[:n]  # one of the next v positions is a tied sample
        for a, b in zip(np.maximum(s.ends - self.length + 1, s.starts).tolist(), s.ends.tolist()):
            may[a:b] = False  # too close to the end of its document
        edge = np.flatnonzero(np.diff(may, prepend=False, append=False))
        return edge.reshape(-1, 2)


class Suffixes:
    """Names of the candidate suffixes of a segment, in text order."""

    def __init__(self, s: X.Segment, runs: np.ndarray, length: int):
        self.s, self.length = s, length
        size = runs[:, 1] - runs[:, 0]
        before = np.cumsum(size) - size
        self.at = np.arange(int(size.sum())) + np.repeat(runs[:, 0] - before, size)
        # hash only the bytes that candidates cover: runs, each with its rest
        wide = size + length - 1
        shift = np.repeat(np.cumsum(wide) - wide - runs[:, 0], size)
        text = s.bytes[np.arange(int(wide.sum())) + np.repeat(runs[:, 0] - (np.cumsum(wide) - wide), wide)]
        self.local, self.text = self.at + shift, text
        lead = np.zeros(len(self.at), np.uint64)
        for k in range(min(4, length)):
            lead = lead << np.uint64(8) | text[self.local + k]
        rest = X.RollingHash(text, ORDER_SEED)(self.local, self.local + length)
        self.order = lead << np.uint64(32) | rest >> np.uint64(32)

    def tie(self, some) -> np.ndarray:
        at = self.local[some]
        return X.RollingHash(self.text, TIE_SEED)(at, at + self.length)

    def shard(self, splits: np.ndarray) -> np.ndarray:
        return np.searchsorted(splits, self.order, side="right")


def _runs(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return np.frombuffer(batch.column("runs")[i].as_py(), "<i4").reshape(-1, 2).astype(np.int64)


def find_candidates(docs: DataFrame, length: int, carry: bool = False) -> DataFrame:
    """Segments with their candidate runs, and every 1024th candidate's order
    (for the splitters)."""
    segs = written(X.segments(docs, ordered=True, carry=carry), "byte-segments")
    schema = T.StructType([*segs.schema.fields]).add("runs", "binary").add("n_candidates", "long").add(
        "splits", T.ArrayType(T.LongType()))
    total = segs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    cover = Cover(length)
    bits = X.shard_bits(int(total * cover.period.mean()))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from X.key_batches(
            row for batch in batches for i in range(batch.num_rows)
            for s in [X.Segment(batch, i)]
            for row in X.cell_rows(s.seg, cover.hashes(s, cover.sample(s)), bits))

    ranks = written(X.answers(segs.mapInArrow(lean(sample), X.KEYS), X.repeated_cells), "sample-answers")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = X.Segment(batch, i)
                runs = cover.candidates(s, bits, batch.column("ranks")[i].as_py())
                some = Suffixes(s, runs, length).order[::1024] ^ SIGN
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, 1) for c in schema.names[:-3]),
                     pa.array([runs.astype("<i4").tobytes()], pa.binary()),
                     pa.array([int((runs[:, 1] - runs[:, 0]).sum())], pa.int64()),
                     pa.array([some.view(np.int64)], pa.list_(pa.int64()))], schema.names)

    out = written(X.attach(segs, ranks, "ranks").mapInArrow(lean(mark), schema), "candidates")
    drop_written(segs)
    drop_written(ranks)
    return out


def splitters(segs: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """(ascending splitters between shards, shards per bucket): quantiles of
    the candidates' order, as many as shards of bounded size need."""
    total = segs.agg(F.sum("n_candidates")).first()[0] or 0
    per_bucket = max(X.LEAST_SHARDS, -(-total // (buckets * X.NAMES_PER_SHARD)))
    shards = buckets * per_bucket
    cuts = [i / shards for i in range(1, shards)]
    found = segs.select(F.explode("splits").alias("x")).agg(
        F.percentile_approx("x", cuts, max(10_000, 4 * shards)).alias("q")).first()["q"] or []
    return np.unique(np.array(found, np.int64)).view(np.uint64) ^ SIGN, per_bucket


def repeated_bytes(docs: DataFrame, length: int, buckets: int, carry: bool) -> tuple[DataFrame, np.ndarray]:
    """Segments with ``earlier``: answers for their candidates, and the splitters."""
    prepare(docs.sparkSession)
    segs = find_candidates(docs, length, carry)
    splits, per_bucket = splitters(segs, buckets)
    found = None
    for bucket in range(0, len(splits) // per_bucket + 1):
        low, high = bucket * per_bucket, (bucket + 1) * per_bucket

        def gather(batches: Iterator[pa.RecordBatch], low=low, high=high) -> Iterator[pa.RecordBatch]:
            def rows():
                for batch in batches:
                    for i in range(batch.num_rows):
                        s = X.Segment(batch, i)
                        suffixes = Suffixes(s, _runs(batch, i), length)
                        shard = suffixes.shard(splits)
                        some = np.flatnonzero((shard >= low) & (shard < high))
                        order, tie = suffixes.order[some], suffixes.tie(some)
                        at, first = X.group(order, tie)
                        one = at[first]
                        yield from X.name_rows(s.seg, order[one], tie[one], shard[some][one], None)
            yield from X.key_batches(rows())

        part = segs.where("n_candidates > 0").mapInArrow(lean(gather), X.KEYS)
        part = written(X.answers(part, X.earlier_names), f"bucket-{bucket}")
        found = part if found is None else found.union(part)
    return X.attach(segs, found, "earlier"), splits


def remove_repeats(docs: DataFrame, length: int = 100, buckets: int = 4, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document.
    ``with_text`` adds ``kept``, the remaining bytes as text less what is
    left of a character that a removed span cuts through, and ``rest``, a
    struct of the other columns of ``docs``."""
    rows, splits = repeated_bytes(docs, length, buckets, with_text)
    schema = T._parse_datatype_string(RESULT)
    if with_text:
        schema.add("kept", "string").add("rest", rows.schema["rest"].dataType.elementType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = X.Segment(batch, i)
                suffixes = Suffixes(s, _runs(batch, i), length)
                order, tie = suffixes.order, suffixes.tie(slice(None))
                at, first = X.group(order, tie)
                shard = np.searchsorted(splits, order[at][first], side="right")
                earlier = X.flags_of(batch.column("earlier")[i].as_py(), shard)
                # all but the first place of a group, and that too if an earlier segment has it
                gone = np.ones(len(at), bool)
                if len(at):
                    gone[np.minimum.reduceat(at, first)] = earlier
                begin = suffixes.at[gone]
                depth = np.zeros(len(s.bytes) + 1, np.int32)
                depth[begin] += 1
                depth[begin + length] -= 1
                covered = np.cumsum(depth[:-1]) > 0
                total = np.concatenate(([0], np.cumsum(covered)))
                opens = covered.copy()
                opens[1:] &= ~covered[:-1]
                inner = s.starts[s.sizes > 0]
                opens[inner] = covered[inner]  # a span ends with its document
                spans = np.concatenate(([0], np.cumsum(opens)))
                n_removed, n_spans = total[s.ends] - total[s.starts], spans[s.ends] - spans[s.starts]
                kept = [s.raw[a:b] if not n else s.bytes[a:b][~covered[a:b]].tobytes()
                        for a, b, n in zip(s.starts.tolist(), s.ends.tolist(), n_removed.tolist())]
                cols = [pa.array(s.doc_ids, pa.int64()), pa.array(s.sizes), pa.array(n_removed.astype(np.int64)),
                        pa.array(n_spans.astype(np.int64)), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if with_text:
                    cols += [pa.array([k.decode(errors="ignore") for k in kept], pa.string()),
                             batch.column("rest")[i].values]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    return rows.mapInArrow(lean(cut), schema)


def cut_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text`` (and ``n_chars``
    counted anew, where there is one); documents of which nothing is left go."""
    found = remove_repeats(docs, length, with_text=True)
    columns = {c: F.col("rest")[c] for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return found.where("n_removed < n_bytes or n_bytes = 0").select(*[columns[c].alias(c) for c in docs.columns])
