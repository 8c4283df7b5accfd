"""Benchmark decontamination by a generalised suffix automaton.

The normalised words of all test items (A-Z lower-cased, runs of ASCII
letters, digits and anything beyond ASCII) go into one suffix automaton.  A
*window* is ``window`` consecutive words of an item; an item of fewer words
is one window.  Training words stream through the automaton, which keeps the
length of the longest match that ends at each word; wherever that reaches a
window's length the window's words are hit and its items are noted.

Only stretches whose word pairs all occur in some item can hold a window of
two words or more, so a bitmap of the items' pairs picks the stretches that
are walked.  It errs on the side of walking, never of skipping.

Maximal runs of hit words are the *spans*.  ``decontaminate`` removes a span
of at least ``min_span`` words, and the whole text where hit words exceed
``max_coverage`` of it.

Scale: documents are read once and never shuffled.  Items are cut into
segments that overlap by a window less one word, the segments are dealt to
blocks of bounded size, and an automaton is built per block in the task that
needs it.  A task gathers documents up to a bounded size and passes them by
every block.  All blocks together are broadcast only up to
``broadcast_bytes``; a larger benchmark is taken in several such rounds over
a written copy of the documents, and the rounds' hits are merged by row.

Defined results: a null or empty text (document or item) has no words; an
item without words is no window; items that repeat an id count once, a null
``item_id`` hits but is not listed; repeated rows of documents are scanned
one by one; null ids stay null; an empty benchmark hits nothing, empty
documents give no rows; extra columns are ignored (``decontaminate`` keeps
them).  Documents must be single rows; the longest must fit a Python worker
about twenty times over.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter.llm.common import lean, prepare, written

# Bytes of a normalised text: letters and digits stay, A-Z is lower-cased,
# bytes beyond ASCII stay, everything else is a space.
NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))
CHUNK = 1 << 22
GATHER_BYTES = 16 << 20
BITMAP_BITS = 20


def word_chunks(raw: bytes) -> Iterator[list[bytes]]:
    """Normalised words, a few megabytes at a time."""
    a = 0
    while a < len(raw):
        b = a + CHUNK
        while b < len(raw) and NORMAL[raw[b]] != 0x20:
            b += 1
        yield raw[a:b].translate(NORMAL).split()
        a = b


class SuffixAutomaton:
    """Suffix automaton of many sequences of word numbers.

    ``marks[state][n]`` lists the items that hold the window of ``n`` words
    which that state recognises; ``up[state]`` is the nearest state with
    marks on the suffix links from it, itself included (-1: none)."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for part in word_chunks(text) for w in part]
            if words:
                sequences.append((item, words))
                state = 0
                for word in words:
                    state = self._extend(state, word)
        self.marks: dict[int, dict[int, set]] = {}
        for item, words in sequences:
            self._mark(item, words, min(window, len(words)))
        self.up = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.up[state] = state if state in self.marks else self.up[self.link[state]] if state else -1
        self.shortest = min((n for by_length in self.marks.values() for n in by_length), default=0)
        pairs = {(a, b) for _, words in sequences for a, b in zip(words, words[1:])}
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        if pairs:
            both = np.array(list(pairs), np.int64)
            self.bitmap[self._slot(both[:, 0], both[:, 1])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return h >> np.uint64(64 - BITMAP_BITS)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state of ``parent``'s longest string followed by ``word``,
        split off the state that holds it where that one holds longer ones."""
        target = self.next[parent][word]
        if self.length[target] == self.length[parent] + 1:
            return target
        clone = self._state(self.length[parent] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier sequence went this way
            return self._split(last, word)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word)
        return new

    def _mark(self, item: str | None, words: list[int], n: int) -> None:
        state = 0
        for i, word in enumerate(words):
            state = self.next[state][word]
            while self.length[self.link[state]] >= n:  # keep the suffix of n words
                state = self.link[state]
            if i + 1 >= n:
                self.marks.setdefault(state, {}).setdefault(n, set()).add(item)

    def numbers(self, raw: bytes) -> np.ndarray:
        """Word numbers of a text, -1 for words that no item holds."""
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, part, repeat(-1)), np.int64, len(part)) for part in word_chunks(raw)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def stretches(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """[begin, end) of the words that may hold a window."""
        if self.shortest <= 1:
            flags, more = words >= 0, 0
        else:
            a, b = words[:-1], words[1:]
            known = (a >= 0) & (b >= 0)
            flags, more = known & self.bitmap[self._slot(np.where(known, a, 0), np.where(known, b, 0))], 1
        edges = np.flatnonzero(np.diff(flags, prepend=False, append=False))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin + more >= self.shortest:
                yield begin, end + more

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set, int]:
        """(words, hit intervals [begin, end) in order of their ends, items,
        longest match that reached a window)."""
        words = self.numbers(raw)
        hits: list[tuple[int, int]] = []
        items: set = set()
        longest = 0
        if not self.shortest or len(words) < self.shortest:
            return len(words), hits, items, longest
        following, link, length, up, marks = self.next, self.link, self.length, self.up, self.marks
        for begin, end in self.stretches(words):
            state = matched = 0
            for i, word in enumerate(words[begin:end].tolist(), begin):
                while state and word not in following[state]:
                    state = link[state]
                    matched = length[state]
                step = following[state].get(word)
                if step is None:
                    continue
                state, matched = step, matched + 1
                if matched < self.shortest:
                    continue
                at, wide = up[state], 0
                while at >= 0:
                    for n, found in marks[at].items():
                        if n <= matched:
                            items |= found
                            wide = max(wide, n)
                    at = up[link[at]] if at else -1
                if wide:
                    hits.append((i + 1 - wide, i + 1))
                    longest = max(longest, matched)
        return len(words), hits, items, longest


def merge(intervals: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint intervals; touching ones are joined."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _word_edges(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words' starts and ends."""
    inside = np.frombuffer(raw.translate(NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def cut(raw: bytes, spans: list[tuple[int, int]], n_words: int, min_span: int, max_coverage: float) -> bytes:
    """The text without its spans of ``min_span`` words or more (a space
    stands for each), empty where hits exceed ``max_coverage`` of its words."""
    if not spans:
        return raw
    if sum(b - a for a, b in spans) > max_coverage * n_words:
        return b""
    starts, ends = _word_edges(raw)
    parts, last = [], 0
    for a, b in spans:
        if b - a >= min_span:
            parts.append(raw[last:starts[a]])
            last = int(ends[b - 1])
    return b" ".join([*parts, raw[last:]])


def item_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """block, item_id (text), words: the items' normalised texts, long ones
    cut into overlapping segments, dealt to blocks of about ``block_bytes``."""
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                held: list[bytes] = []
                size = 0
                rows = []

                def flush() -> None:
                    nonlocal held, size
                    rows.append(b" ".join(held))
                    held = held[len(held) - window + 1:] if window > 1 else []
                    size = sum(map(len, held)) + len(held)

                for part in word_chunks(value.as_py() or b""):
                    for word in part:
                        held.append(word)
                        size += len(word) + 1
                        if size >= block_bytes // 4 and len(held) >= window:
                            flush()
                # what follows the last flush is a segment of its own if it has a window that none has
                if held and (not rows or len(held) >= window):
                    flush()
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()),
                         pa.array(rows, pa.binary())], ["item_id", "part", "words"])

    parts = benchmark.select(F.col("item_id").cast("string"), F.col("text")).mapInArrow(
        lean(segment), "item_id string, part long, words binary")
    parts = written(parts, "benchmark-parts")
    total = parts.agg(F.sum(F.length("words") + 1)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    return parts.withColumn("block", F.pmod(F.xxhash64("item_id", "part"), F.lit(blocks)).cast("int"))


@functools.lru_cache(maxsize=1)
def _automaton(key: str, packed: bytes, window: int) -> SuffixAutomaton:
    rows = pa.ipc.open_stream(packed).read_all()
    return SuffixAutomaton(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()), window)


def _broadcast_blocks(blocks: DataFrame, numbers: list[int]) -> list[tuple[str, object]]:
    """One broadcast for each block number: its items as an Arrow stream.
    Blocks have a bounded size by construction."""
    out = []
    for b in numbers:
        rows = blocks.where(F.col("block") == b).select("item_id", "words").orderBy("item_id", "words").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as stream:
            stream.write_table(rows)
        out.append((uuid.uuid4().hex, blocks.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())))
    return out


SPANS = "array<struct<begin:long,end:long>>"
FOUND = f"n_words long, n_hit long, longest long, spans {SPANS}, items array<string>"


def _scanner(blocks: list[tuple[str, object]], window: int):
    """For each text: (words, spans, items, longest) over ``blocks``."""
    def scan(texts: list[bytes]) -> list[tuple]:
        found = [[0, [], set(), 0] for _ in texts]
        for key, block in blocks:
            automaton = _automaton(key, block.value, window)
            for slot, raw in zip(found, texts):
                n, hits, items, longest = automaton.scan(raw)
                slot[0] = n
                slot[1] = merge([*slot[1], *hits]) if hits else slot[1]
                slot[2] |= items
                slot[3] = max(slot[3], longest)
        return found
    return scan


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined up to a bounded size, so that a block is loaded for
    many documents at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > GATHER_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _columns(found: list[tuple]) -> list[pa.Array]:
    spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return [pa.array([f[0] for f in found], pa.int64()),
            pa.array([sum(b - a for a, b in f[1]) for f in found], pa.int64()),
            pa.array([f[3] for f in found], pa.int64()),
            pa.array([[{"begin": a, "end": b} for a, b in f[1]] for f in found], spans),
            pa.array([sorted(i for i in f[2] if i is not None) for f in found], pa.list_(pa.string()))]


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 1 << 19,
                    broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` (its columns kept) with ``contamination``: words, hit words,
    longest match, spans [begin, end) in words, and the items (as text,
    sorted) whose windows occur."""
    prepare(docs.sparkSession)
    docs = docs.drop("contamination")
    blocks = written(item_blocks(benchmark, window, block_bytes), "benchmark-blocks")
    numbers = [r[0] for r in blocks.select("block").distinct().orderBy("block").collect()]
    a_round = max(1, broadcast_bytes // block_bytes)
    rounds = [numbers[i:i + a_round] for i in range(0, len(numbers), a_round)] or [[]]
    found_type = T._parse_datatype_string(FOUND)

    def pass_over(rows: DataFrame, part: list[int]) -> DataFrame:
        scan = _scanner(_broadcast_blocks(blocks, part), window)
        at = rows.columns.index("text")
        names = [*(f"c{i}" for i in range(len(rows.columns))), "contamination"]
        schema = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, rows.schema)]
                              + [T.StructField("contamination", found_type)])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _gathered(batches):
                texts = [t.as_py() or b"" for t in batch.column(at).cast(pa.binary())]
                found = pa.StructArray.from_arrays(_columns(scan(texts)), found_type.names)
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names)

        out = rows.mapInArrow(lean(work), schema)
        return out.toDF(*rows.columns, "contamination")

    if len(rounds) == 1:
        return pass_over(docs, rounds[0])
    rows = written(docs.select(F.struct(*docs.columns).alias("doc"), "text",
                               F.monotonically_increasing_id().alias("row")), "numbered-documents")
    hits = [pass_over(rows.select("row", "text"), part).select("row", "contamination.*") for part in rounds]
    every = functools.reduce(DataFrame.union, hits)
    joined = every.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.max("longest").alias("longest"),
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    joined = joined.select("row", F.struct("n_words", total.alias("n_hit"), "longest", "spans", "items")
                           .alias("contamination"))
    return rows.select("row", "doc").join(joined, "row").select("doc.*", "contamination")


def _merged(spans):
    """Disjoint spans, touching ones joined, from an array of spans."""
    def step(done, s):
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                         F.array(F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["begin"]), grown).otherwise(
            F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), step)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, min_span: int = 10,
                  max_coverage: float = 0.5, **limits) -> DataFrame:
    """``docs`` with spans cut out of ``text`` (see :func:`cut`) and the
    column ``contamination`` of :func:`match_benchmark`."""
    matched = match_benchmark(docs, benchmark, window, **limits)
    at, found = matched.columns.index("text"), matched.columns.index("contamination")
    names = [f"c{i}" for i in range(len(matched.columns))]
    schema = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, matched.schema)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, hit in zip(batch.column(at).cast(pa.binary()), batch.column(found).to_pylist()):
                spans = [(s["begin"], s["end"]) for s in hit["spans"]]
                raw = value.as_py()
                texts.append(raw if raw is None else
                             cut(raw, spans, hit["n_words"], min_span, max_coverage).decode())
            cols = list(batch.columns)
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return matched.mapInArrow(lean(work), schema).toDF(*matched.columns)
