"""Exact matching of text windows between segments of a corpus.

Documents are gathered into *segments* of about a megabyte, written once, so
that every pass reads the same rows.  A pass computes a key for each window
of a segment with rolling hashes, sends the distinct keys of the segment
(sorted, packed, dealt to shards by key range) and gets back one bit a key:
it is repeated, or an earlier segment holds it.  Texts never travel with
their windows, a key that is frequent in a segment travels once, and a shard
holds a bounded number of keys by the choice of the number of shards.

Two kinds of key: a 32-bit *cell* inside its shard (a sparse count-min row:
equal windows share a cell, so counts are over-estimated and nothing is
lost), and an exact *name* of 128 bits, ``order`` and ``tie``.

A segment is one row, so the longest text must fit a Python worker about
fifty times over.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.llm.common import lean, release_memory, shuffle_partitions

SEGMENT = "seg long, doc_ids array<long>, sizes array<int>, blob binary"
KEYS = "seg long, shard int, high binary, low binary, tie binary, many binary"
BITS = "seg long, shard int, bits binary"
KEYS_PER_SHARD = 4 << 20
NAMES_PER_SHARD = 2 << 20
LEAST_SHARDS = 24


def segments(docs: DataFrame, ordered: bool, clean: Callable[[bytes], bytes] | None = None,
             carry: bool = False, segment_bytes: int = 900_000) -> DataFrame:
    """Rows of :data:`SEGMENT`.  ``ordered``: segments follow each other by
    document id (equal ids: by a hash of the text), numbers ascending.
    ``carry`` adds ``rest``, the other columns of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *([F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")] if carry else []))
    schema = T._parse_datatype_string(SEGMENT)
    if carry:
        schema.add("rest", T.ArrayType(rows.schema["rest"].dataType))
    if ordered:  # ranges of the whole order, so an id that many rows share is cut as well
        order = ["doc_id", F.xxhash64("text")]
        rows = by_range(rows, docs, order).sortWithinPartitions(*order)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        seg, packer = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(3)
        ids, texts, rest, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            cols = [pa.array([seg], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                    pa.array([packer.compress(b"".join(texts))], pa.binary())]
            if carry:
                values = pa.concat_arrays(rest)
                cols.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(cols, schema.names)

        for batch in batches:
            taken = 0  # rows of this batch whose other columns are in ``rest``
            for i, (doc, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()))):
                text = value.as_py() or b""
                ids.append(doc)
                texts.append(clean(text) if clean else text)
                size += len(texts[-1])
                if size >= segment_bytes:
                    if carry:
                        rest.append(batch.column(2).slice(taken, i + 1 - taken))
                    taken = i + 1
                    yield row()
                    seg, ids, texts, rest, size = seg + 1, [], [], [], 0
            if carry and taken < batch.num_rows:
                rest.append(batch.column(2).slice(taken))
        if ids:
            yield row()

    return rows.mapInArrow(lean(gather), schema)


def by_range(rows: DataFrame, docs: DataFrame, order: list, bytes_per_part: int = 512 << 20) -> DataFrame:
    """Ranges of ``order``: as many as the session's shuffle partitions, more
    where a range would hold over ``bytes_per_part`` of the texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // bytes_per_part
    return rows.repartitionByRange(parts, *order) if parts > shuffle_partitions(rows.sparkSession) else rows.repartitionByRange(*order)


class Segment:
    """A row of :data:`SEGMENT`: bytes, document starts and sizes."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.seg = batch.column("seg")[i].as_py()
        self.doc_ids = batch.column("doc_ids")[i].as_py()
        self.sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
        self.raw = zstandard.ZstdDecompressor().decompress(
            batch.column("blob")[i].as_py(), max_output_size=max(1, int(self.sizes.sum())))
        self.bytes = np.frombuffer(self.raw, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes


@functools.lru_cache(maxsize=8)
def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers of an odd base and of its inverse, modulo 2^64."""
    rng = np.random.default_rng(seed)
    base = int(rng.integers(1 << 62)) * 2 + 1
    values = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return values, np.cumprod(up), np.cumprod(down)


class RollingHash:
    """64-bit hash of any interval of ``raw`` from one prefix sum."""

    def __init__(self, raw: np.ndarray, seed: int):
        values, up, self.down = _powers(seed, 1 << max(16, int(len(raw)).bit_length()))
        self.prefix = np.empty(len(raw) + 1, np.uint64)
        self.prefix[0] = 0
        term = self.prefix[1:]  # in place: fresh arrays of this size cost more than the arithmetic
        np.take(values, raw, mode="clip", out=term)
        term *= up[:len(raw)]
        np.cumsum(term, out=term)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = self.prefix.take(end)
        h -= self.prefix.take(begin)
        h *= self.down.take(begin)
        for shift, factor in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(32)
        return h


def group(order: np.ndarray, tie: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(permutation that sorts by order, then tie; starts of the groups of
    equal keys in it).  Inside a group the permutation is in no order."""
    at = np.argsort(order)
    key = order.take(at)
    fresh = np.ones(len(at), bool)
    np.not_equal(key[1:], key[:-1], out=fresh[1:])
    if tie is not None and len(at):
        second = tie.take(at)
        mixed = ~fresh
        mixed[1:] &= second[1:] != second[:-1]
        if mixed.any():  # equal order, other tie: sort those few groups fully
            number = np.cumsum(fresh) - 1
            odd = np.zeros(number[-1] + 1, bool)
            odd[number[mixed]] = True
            place = np.flatnonzero(odd[number])
            at[place] = at[place][np.lexsort((second[place], number[place]))]
            second = tie.take(at)
            fresh[1:] |= second[1:] != second[:-1]
    return at, np.flatnonzero(fresh)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes() if flags.any() else b""


def unpack_bits(bits: bytes, n: int) -> np.ndarray:
    if not bits:
        return np.zeros(n, bool)
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def _delta(values: np.ndarray) -> bytes:
    """Ascending 32-bit values as byte planes of their differences: the upper
    planes are nearly constant, which the shuffle's codec removes."""
    d = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return d.view(np.uint8).reshape(-1, 4).T.tobytes()


def _undelta(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def shard_bits(keys: int) -> int:
    """Shards of cells, as a power of two, for a total number of keys."""
    return max(LEAST_SHARDS, -(-keys // KEYS_PER_SHARD) - 1).bit_length()


def cells_of(h: np.ndarray, bits: int, cell_bits: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort hashes into cells: (permutation, group starts, distinct cells);
    a cell is the hash's first ``cell_bits + bits`` bits."""
    cell = h >> np.uint64(64 - cell_bits - bits)
    at, first = group(cell)
    return at, first, cell[at][first]


def cell_rows(seg: int, h: np.ndarray, bits: int, cell_bits: int = 32, first_shard: int = 0) -> Iterator[tuple]:
    at, first, cell = cells_of(h, bits, cell_bits)
    many = np.diff(first, append=len(at)) > 1
    shard = (cell >> np.uint64(cell_bits)).astype(np.int64) + first_shard
    cell = (cell & np.uint64((1 << cell_bits) - 1)).astype(np.uint32)
    for a, b in _runs(shard):
        yield seg, int(shard[a]), None, _delta(cell[a:b]), None, pack_bits(many[a:b])


def name_rows(seg: int, order: np.ndarray, tie: np.ndarray, shard: np.ndarray, many: np.ndarray | None) -> Iterator[tuple]:
    """Rows of distinct sorted names with their (ascending) shards."""
    high, low = (order >> np.uint64(32)).astype("<u4"), order.astype("<u4")
    for a, b in _runs(shard):
        yield (seg, int(shard[a]), _delta(high[a:b]), low[a:b].tobytes(), tie[a:b].astype("<u8").tobytes(),
               pack_bits(many[a:b]) if many is not None else None)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(values)) + 1
    return zip(np.concatenate(([0], edges)).tolist(), np.concatenate((edges, [len(values)])).tolist()) if len(values) else iter(())


def key_batches(rows: Iterator[tuple], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in KEYS.split(", ")]
    cols, held = [[] for _ in names], 0
    for row in rows:
        for col, value in zip(cols, row):
            col.append(value)
        held += sum(len(v) for v in row[2:] if v)
        if held >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
            cols, held = [[] for _ in names], 0
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _bits_table(table: pa.Table, flags: np.ndarray, counts: list[int]) -> pa.Table:
    ends = np.cumsum(counts)
    bits = [pack_bits(flags[b - n:b]) for n, b in zip(counts, ends)]
    return pa.table({"seg": table.column("seg"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})


def _many(table: pa.Table, counts: list[int]) -> np.ndarray:
    return np.concatenate([unpack_bits(m, n) for m, n in zip(table.column("many").to_pylist(), counts)])


def repeated_cells(table: pa.Table) -> pa.Table:
    """Cells of a shard with an estimated count of two or more."""
    parts = [_undelta(v) for v in table.column("low").to_pylist()]
    counts = [len(p) for p in parts]
    cells = np.concatenate(parts)
    many = _many(table, counts)
    s = np.sort(cells)
    twice = np.unique(np.concatenate((s[1:][s[1:] == s[:-1]], cells[many])))
    if not len(twice):
        return _bits_table(table, many, counts)
    at = np.minimum(np.searchsorted(twice, cells), len(twice) - 1)
    return _bits_table(table, twice[at] == cells, counts)


def _names(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int]]:
    high = [_undelta(v) for v in table.column("high").to_pylist()]
    low = b"".join(table.column("low").to_pylist())
    order = np.concatenate(high).astype(np.uint64) << np.uint64(32) | np.frombuffer(low, "<u4")
    return order, np.frombuffer(b"".join(table.column("tie").to_pylist()), "<u8"), [len(h) for h in high]


def repeated_names(table: pa.Table) -> pa.Table:
    """Names of a shard that occur twice or more in all."""
    order, tie, counts = _names(table)
    at, first = group(order, tie)
    sizes = np.diff(first, append=len(at))
    often = (sizes > 1) | np.logical_or.reduceat(_many(table, counts)[at], first)
    flags = np.zeros(len(at), bool)
    flags[at] = np.repeat(often, sizes)
    return _bits_table(table, flags, counts)


def earlier_names(table: pa.Table) -> pa.Table:
    """Names of a shard that a segment with a smaller number holds too."""
    table = table.sort_by("seg")
    order, tie, counts = _names(table)
    at, first = group(order, tie)
    flags = np.ones(len(at), bool)
    flags[np.minimum.reduceat(at, first)] = False  # rows came by segment: the smallest place is the earliest
    return _bits_table(table, flags, counts)


def answers(keys: DataFrame, reducer: Callable[[pa.Table], pa.Table]) -> DataFrame:
    def reduce(table: pa.Table) -> pa.Table:
        try:
            return reducer(table)
        finally:
            release_memory()
    return keys.groupBy("shard").applyInArrow(reduce, BITS)


def attach(segs: DataFrame, bits: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: the answers to a segment's keys, by shard.  The texts
    are the streamed side of the join and are not sorted."""
    per_seg = bits.groupBy("seg").agg(F.sort_array(F.collect_list(F.struct("shard", "bits"))).alias(name))
    return segs.join(per_seg.hint("shuffle_hash"), "seg", "left")


def flags_of(answer: list[dict] | None, shard: np.ndarray) -> np.ndarray:
    """The bits of a segment's distinct keys, whose (ascending) shards are given."""
    got = {a["shard"]: a["bits"] for a in answer or []}
    out = np.zeros(len(shard), bool)
    for a, b in _runs(shard):
        out[a:b] = unpack_bits(got.get(int(shard[a]), b""), b - a)
    return out
