"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints of word shingles are 64 bits.  Cut into ``blocks`` blocks, two
fingerprints that differ in at most ``max_bits`` bits agree on at least
``blocks - max_bits`` of them, so they meet under one of the choices of that
many blocks.  Distinct fingerprints only are dealt by (choice, shared bits);
the pairs that meet are verified by Hamming distance.  A crowded key is cut
into cells (pairs of sub-blocks of a bounded size), and a cell emits a
spanning forest of its links, never all its pairs.

Defined results: a null, empty or word-less text has fingerprint 0; documents
with equal fingerprints are linked; repeated rows get one row each; an empty
table gives no rows; extra columns are ignored.  A row without id is grouped by
its fingerprint like any other; null ids rank behind all others, so only a
group that has no id at all has a null ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import lean, prepare, shuffle_partitions, written
from arbiter.llm.components import connected_components, local_labels

SEED = 42
CHUNK = 1 << 22


def _words(text: str) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words, a few megabytes at a time."""
    raw = text.encode()
    a = 0
    while a < len(raw):
        b = a + CHUNK
        while b < len(raw) and raw[b] not in b" \t\n\r\x0b\x0c":
            b += 1
        yield raw[a:b].lower().split()
        a = b


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set if it is set in over half the shingles' XXH64 values."""
    import xxhash
    ones, n, carry = np.zeros(64, np.int64), 0, []

    def add(words: list[bytes], size: int) -> int:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        k = len(words) - size + 1
        slices = [line[a:b] for a, b in zip(starts[:k].tolist(), ends[size - 1:].tolist())]
        for at in range(0, k, 1 << 16):
            part = slices[at:at + (1 << 16)]
            h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), "<u8", len(part))
            ones[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        return k

    for words in _words(text or ""):
        words = carry + words
        if len(words) >= shingle:
            n += add(words, shingle)
            words = words[len(words) - shingle + 1:]
        carry = words
    if not n and carry:
        n = add(carry, len(carry))
    if not n:
        return 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long)."""
    prepare(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       "text").mapInArrow(lean(compute), "doc_id long, text_hash long, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Masks (signed) of every choice of blocks - max_bits blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(one, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def cell_links(key: np.ndarray, value: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with equal keys (``key`` is sorted) and close values."""
    left, right = [], []
    value = value.view(np.uint64)  # bitwise_count takes the absolute value of signed numbers
    alive = np.arange(len(key))
    for lag in range(1, len(key)):
        alive = alive[alive + lag < len(key)]
        alive = alive[key[alive] == key[alive + lag]]
        if not len(alive):
            break
        near = alive[np.bitwise_count(value[alive] ^ value[alive + lag]) <= max_bits]
        left.append(near)
        right.append(near + lag)
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def links(distinct: DataFrame, max_bits: int = 2, blocks: int = 4, cell_rows: int = 1024) -> DataFrame:
    """Edges (a, b) between the ``rep`` of close fingerprints of ``distinct``
    (fp, rep): a spanning forest of the links of every cell."""
    spark = distinct.sparkSession
    masks = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask"))
                      for i, m in enumerate(block_masks(blocks, max_bits))])
    keyed = (distinct.select("fp", "rep", F.explode(masks).alias("m"))
             .select("fp", "rep", F.col("m.choice").alias("choice"),
                     F.col("fp").bitwiseAND(F.col("m.mask")).alias("shared")))
    crowd = keyed.groupBy("choice", "shared").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = F.ceil(F.col("n") / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    met = (keyed.join(crowd, ["choice", "shared"]).withColumn("cells", cells).withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
           .select("fp", "rep", F.xxhash64("choice", "shared", F.least("own", "other"),
                                           F.greatest("own", "other")).alias("cell")))
    dealt = met.repartition(shuffle_partitions(spark), "cell").sortWithinPartitions("cell", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3

        def forest(cell, fp, rep):
            i, j = cell_links(cell, fp, max_bits)
            label = local_labels(len(fp), i, j)
            tied = np.flatnonzero(label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(rep[tied]), pa.array(rep[label[tied]])], ["a", "b"])

        for batch in batches:
            cols = [np.concatenate((k, batch.column(c).to_numpy())) for k, c in zip(kept, ("cell", "fp", "rep"))]
            whole = np.searchsorted(cols[0], cols[0][-1]) if len(cols[0]) else 0  # the last cell may go on
            kept = [c[whole:] for c in cols]
            yield forest(*(c[:whole] for c in cols))
        yield forest(*kept)

    return dealt.mapInArrow(lean(verify), "a long, b long")


def grouped(docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp) and fingerprints (fp, low: its smallest
    doc_id, group: the smallest fingerprint linked to it)."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    # fingerprints are the nodes: ids may be null or stand for several texts
    nodes = connected_components(links(distinct.select("fp", F.col("fp").alias("rep")), max_bits, blocks))
    return prints, distinct.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("group"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id of
    the group)."""
    prints, groups = grouped(docs, shingle, max_bits, blocks)
    groups = written(groups, "fingerprint-groups")
    lowest = groups.groupBy("group").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    labels = groups.join(lowest, "group", "left").select("fp", F.least("low", "component_id").alias("component_id"))
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates, all columns as
    they are: the smallest id (a null one last), of equal ids the smallest hash
    of the text, of these the smallest hash of the whole row, and of rows that
    are equal in every column one."""
    prints, groups = grouped(docs, shingle, max_bits)
    first = (prints.join(groups, "fp").groupBy("group")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
             .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")))
    whole = F.sha2(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}), 256)
    hashed = docs.withColumn("_text_hash", F.xxhash64("text"))
    kept = hashed.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left_semi")
    # one row per (id, text): the smallest by a hash of everything in it
    return (kept.groupBy("doc_id", "_text_hash").agg(F.min_by(F.struct(*docs.columns), whole).alias("row"))
            .select("row.*"))
