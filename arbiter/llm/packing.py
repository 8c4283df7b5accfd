"""Packing of tokenised documents into fixed windows, best-fit decreasing.

A document is tokenised, a separator id is appended, and it is cut into full
windows plus one remainder.  Pieces are dealt to shards by a hash of their
key; inside a shard they arrive longest first, and a segment tree indexed by
remaining capacity finds the open window that the piece fills most tightly.
Only counters travel through a shard (piece keys and lengths); token ids are
carried along when asked for.  A shard is one sorted partition, so its size
is set by the number of shards and no window is shared between tasks.

Defined results: a null text is empty and has just the separator; repeated
rows are packed one by one; an empty table gives no pieces; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import lean, parts_for, prepare, shuffle_partitions

SPECIAL = "<|endoftext|>"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Ids of a byte-level BPE vocabulary.

    ``tokenizer`` is a ``tokenizers`` JSON file.  ``ranks`` optionally names
    the same vocabulary as a rank file with its split pattern: ``tiktoken``
    gives the same ids from it about four times as fast.  Texts that hold the
    special token's own string are always left to ``tokenizers``, and so are
    those on which ``tiktoken`` gives up (its split pattern runs out of stack
    on some very long runs of white space).
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(tokenizer)
        self.fast = None
        if ranks:
            import base64
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and SPECIAL not in text:
            try:
                return self.fast.encode_to_numpy(text).astype("<u4", copy=False)
            except ValueError:
                pass
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
           window: int = 1024, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``doc_id, text``: full windows, then the remainder."""
    prepare(docs.sparkSession)
    schema = PIECE + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64()] * 5 + [pa.binary()] * with_ids
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(separator)).astype("<u4")
                for a in range(0, len(ids), window):
                    part = ids[a:a + window].tobytes()
                    row = (doc, a, len(part) // 4, zlib.crc32(part), len(ids), part)
                    for col, value in zip(cols, row):
                        col.append(value)
                if len(cols[0]) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
                    cols = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(lean(cut), schema)


class CapacityTree:
    """Segment tree over remaining capacities; a leaf lists the open windows
    that have exactly so much room, an inner node counts those below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window_no: int) -> None:
        self.open[room].append(window_no)
        node = room + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Tightest (room, window) with room >= need, removed from the tree."""
        count, node = self.count, need + self.size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def pack(piece_rows: DataFrame, window: int = 1024, shards: int | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have the columns of
    :func:`pieces`.  Within a sequence offsets run from 0 without a gap."""
    spark = piece_rows.sparkSession
    shards = shards or shuffle_partitions(spark)
    out = piece_rows.schema
    for name in ("sequence_id", "offset"):
        out = out.add(name, "long")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, tree, opened = TaskContext.get().partitionId(), CapacityTree(window), 0
        for batch in batches:
            seqs, offsets = [], []
            for length in batch.column("length").to_pylist():
                found = tree.take(length) if length < window else None
                if found is None:
                    room, no = window, opened
                    opened += 1
                else:
                    room, no = found
                if room > length:
                    tree.add(room - length, no)
                seqs.append((shard << 40) | no)
                offsets.append(window - room)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(seqs, pa.int64()), pa.array(offsets, pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"])

    dealt = piece_rows.repartition(shards, F.xxhash64("doc_id", "start", "ids_crc32"))
    order = [F.desc("length"), "doc_id", "start", "ids_crc32"]
    return dealt.sortWithinPartitions(*order).mapInArrow(lean(fit), out)


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
                   window: int = 1024, rows_per_shard: int = 20_000, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``; see the module text.  The number of
    shards follows the documents alone, so a shard and its tree of open
    windows stay the same size however large the corpus is."""
    prepare(docs.sparkSession)
    shards = parts_for(docs.count(), rows_per_shard)
    return pack(pieces(docs, tokenizer, ranks, pattern, window, with_ids=with_ids), window, shards)


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence (``packed`` made ``with_ids``): little-endian
    32-bit ids, pieces in offset order; a sequence holds one window at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), parts.alias("parts")).select(
        "sequence_id", "tokens",
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
