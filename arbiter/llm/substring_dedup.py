"""Exact removal of repeated word windows, behind a count-min prefilter.

Pass 1 sketches the windows: a count-min sketch of ``SKETCH_ROWS`` rows, each
with a hash of its own and counters saturated at two.  A segment sends its
counters that are not zero, a shard (a range of cells of one row) merges the
sketches of all segments, and each segment gets back which of its cells are
at two or more.  A window's estimate is the least of its rows', so it is
never too low: a window whose cell is below two in any row occurs once.  Rows
have ``2 ** CELL_BITS`` cells a shard and more shards as the corpus grows, so
the load of a row, and with it the share of windows passed on for nothing,
stays the same at every size.

Pass 2 groups exactly only the windows so estimated, by 128 bits of BLAKE2 of
their words; a window that occurs twice or more, in one document or in
several, is a repeat, and all words it covers go.

Defined results: a null text has no words; a document shorter than a window
loses nothing; repeated rows are separate documents, so they repeat each
other; null ids stay null; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm import exchange as X
from arbiter.llm.common import lean, prepare, written

SKETCH_SEED, SKETCH_ROWS, CELL_BITS = 3, 2, 26
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def single_spaced(text: bytes) -> bytes:
    """Words (runs of anything but ASCII white space) joined by one space."""
    return b" ".join(text.split())


class WordWindows:
    """Words and windows of a segment of single-spaced documents."""

    def __init__(self, s: X.Segment, size: int):
        self.s = s
        full = s.sizes > 0
        blanks = np.flatnonzero(s.bytes == 32)
        self.begin = np.sort(np.concatenate((s.starts[full], blanks + 1)))
        self.end = np.sort(np.concatenate((s.ends[full], blanks)))
        self.doc = np.searchsorted(s.ends, self.begin, side="right")
        # windows: first words whose last word is in the same document
        n = max(0, len(self.begin) - size + 1)
        self.at = np.flatnonzero(self.doc[:n] == self.doc[size - 1:size - 1 + n])
        self.size = size

    def hashes(self) -> list[np.ndarray]:
        """A hash of every window for each row of the sketch."""
        h = X.RollingHash(self.s.bytes, SKETCH_SEED)(self.begin[self.at], self.end[self.at + self.size - 1])
        rows = [h]
        for r in range(1, SKETCH_ROWS):
            g = (h ^ np.uint64(0x9E3779B97F4A7C15 * r % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
            g ^= g >> np.uint64(32)
            rows.append(g * np.uint64(0xD6E8FEB86659FD93))
        return rows

    def sketch(self, bits: int) -> Iterator[tuple]:
        for r, h in enumerate(self.hashes()):
            yield from X.cell_rows(self.s.seg, h, bits, CELL_BITS, r << bits)

    def estimated(self, bits: int, answer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(windows estimated repeated, their order, their tie): both halves
        of a digest of the window's words."""
        often = np.ones(len(self.at), bool)
        for r, h in enumerate(self.hashes()):
            at, first, cell = X.cells_of(h, bits, CELL_BITS)
            flags = X.flags_of(answer, (cell >> np.uint64(CELL_BITS)).astype(np.int64) + (r << bits))
            often[at] &= np.repeat(flags, np.diff(first, append=len(at)))
        self.at = self.at[often]
        raw, blake = self.s.raw, hashlib.blake2b
        digests = b"".join([blake(raw[a:b], digest_size=16).digest() for a, b in zip(
            self.begin[self.at].tolist(), self.end[self.at + self.size - 1].tolist())])
        names = np.frombuffer(digests, "<u8").reshape(-1, 2)
        return self.at, names[:, 0].copy(), names[:, 1].copy()


def _shard_of(order: np.ndarray, bits: int) -> np.ndarray:
    return (order >> np.uint64(64 - bits)).astype(np.int64)


def repeated_words(docs: DataFrame, window: int = 35) -> tuple[DataFrame, int]:
    """Segments of single-spaced documents with the answers of both passes
    (``sketch`` and ``exact``), and the shard bits of the passes."""
    prepare(docs.sparkSession)
    segs = written(X.segments(docs, ordered=False, clean=single_spaced), "word-segments")
    total = segs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    bits = X.shard_bits(total // 6)  # about as many windows as words

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from X.key_batches(
            row for batch in batches for i in range(batch.num_rows)
            for s in [X.Segment(batch, i)]
            for row in WordWindows(s, window).sketch(bits))

    estimate = written(X.answers(segs.mapInArrow(lean(sketch), X.KEYS), X.repeated_cells), "sketch-answers")

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    s = X.Segment(batch, i)
                    _, order, tie = WordWindows(s, window).estimated(bits, batch.column("sketch")[i].as_py())
                    at, first = X.group(order, tie)
                    yield from X.name_rows(s.seg, order[at][first], tie[at][first], _shard_of(order[at][first], bits),
                                           np.diff(first, append=len(at)) > 1)
        yield from X.key_batches(rows())

    exact = written(X.answers(X.attach(segs, estimate, "sketch").mapInArrow(lean(names), X.KEYS), X.repeated_names),
                    "exact-answers")
    return X.attach(X.attach(segs, estimate, "sketch"), exact, "exact"), bits


def remove_repeats(docs: DataFrame, window: int = 35, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document;
    ``with_text`` adds ``kept``: the remaining words, joined by one space."""
    rows, bits = repeated_words(docs, window)
    schema = RESULT + (", kept string" if with_text else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = X.Segment(batch, i)
                w = WordWindows(s, window)
                windows, order, tie = w.estimated(bits, batch.column("sketch")[i].as_py())
                at, first = X.group(order, tie)
                flags = X.flags_of(batch.column("exact")[i].as_py(), _shard_of(order[at][first], bits))
                repeat = windows[at[np.repeat(flags, np.diff(first, append=len(at)))]]
                depth = np.zeros(len(w.begin) + 1, np.int64)
                depth[repeat] += 1
                depth[repeat + window] -= 1
                gone = np.cumsum(depth)[:-1] > 0
                edge = np.searchsorted(w.doc, np.arange(len(s.sizes) + 1))
                kept, removed = [], []
                for a, b, x, y in zip(edge, edge[1:], s.starts, s.ends):
                    removed.append(int(gone[a:b].sum()))
                    kept.append(s.raw[x:y] if not removed[-1] else b" ".join(
                        s.raw[w.begin[j]:w.end[j]] for j in a + np.flatnonzero(~gone[a:b])))
                cols = [pa.array(s.doc_ids, pa.int64()), pa.array(np.diff(edge), pa.int64()),
                        pa.array(removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if with_text:
                    cols.append(pa.array([k.decode() for k in kept], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(lean(cut), schema)
