"""Alignment of two tokenizers over a corpus by merge-path partitioning.

Both tokenizers cut the same bytes (a space and the text), so a document is
two ascending lists of byte offsets at which tokens end.  The lists of a
batch of documents are laid end to end and merged in *pieces*: a binary
search along diagonals of the merge grid cuts the pair of lists so that each
piece merges the same number of ends, whatever the documents' lengths, and no
piece needs another one.  A piece emits the offsets at which tokens of both
sides end together; where an offset's two ends fall on either side of a cut
they are stitched.  Between two such offsets lies a *group*: the smallest run
of tokens of both sides that covers the same bytes.  Every token of A links
with every token of B in its group.

Corpus statistics: documents are gathered into segments of a few megabytes,
written once; a segment sends each distinct id pair once, with the number of
its documents that hold it, gets back the corpus-wide numbers by a join, and
gives every document its sums.  A pair that all documents hold is one row a
segment, not one a document, and no table is broadcast.

Groups whose link count is large are expanded by their distinct ids, so work
grows with distinct pairs and not with the square of a run of equal tokens.

Defined results: a text that is null or empty, or whose joined token bytes on
either side differ from space + text, has no tokens: zeros and an empty
string; null ids stay null; repeated rows are separate documents; an empty
table gives no rows; extra columns are ignored.  The strings of special
tokens are plain text.  A document is tokenised in one task (B by chunks where
its vocabulary allows), so the longest must fit a worker about fifty times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import lean, prepare, written
from arbiter.llm.packing import Encoder

SEGMENT_BYTES = 4 << 20
BATCH_BYTES = 1 << 20
CHUNK_CHARS = 1 << 18
WORK = 1 << 15      # ends merged by a piece
FULL_GROUP = 256    # links up to which a group is expanded token by token
PAIRS_AT_ONCE = 1 << 22
SPACE = "▁"


class ByteSide:
    """Byte-level BPE: ids of space + text, and each id's bytes."""

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        self.encoder = Encoder(tokenizer, ranks, pattern)
        self.encoder.full.encode_special_tokens = True  # their strings are plain text
        vocabulary = self.encoder.full.get_vocab()
        byte_of = {c: b for b, c in enumerate(self._byte_letters())}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in byte_of for c in token):
                self.bytes[i] = bytes(byte_of[c] for c in token)

    @staticmethod
    def _byte_letters() -> list[str]:
        """The letter that byte-level BPE writes for each byte: itself where
        it is printable, else the next code point from 256 on."""
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        spare = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]

    def ids(self, text: str) -> np.ndarray:
        if self.encoder.fast is not None:
            try:
                return self.encoder.fast.encode_to_numpy(" " + text).astype(np.int64)
            except ValueError:  # its split pattern ran out of stack
                pass
        return np.array(self.encoder.full.encode(" " + text, add_special_tokens=False).ids, np.int64)


class PieceSide:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, model: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                      for i, p in enumerate(pieces)]
        # a space that follows a letter then always begins a piece
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def _chunks(self, text: str) -> Iterator[str]:
        a = 0
        while self.splits and len(text) - a > CHUNK_CHARS:
            b = text.find(" ", a + CHUNK_CHARS)
            while b >= 0 and (text[b - 1] == " " or text[b + 1:b + 2] in (" ", "")):
                b = text.find(" ", b + 1)
            if b < 0:
                break
            yield text[a:b]
            a = b + 1  # the model puts this space back
        yield text[a:]

    def ids(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(self.model.encode(c), np.int64) for c in self._chunks(text)])


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts (i, j) of two ascending lists into pieces of ``work`` elements:
    a[:i] and b[:j] are the first i + j of the merged list (a before b where
    they are equal).  One binary search per diagonal, all at once."""
    diagonal = np.minimum(np.arange(0, len(a) + len(b) + work, work), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        other = np.clip(diagonal - middle - 1, 0, max(len(b) - 1, 0))
        further = open_ & (a.take(middle, mode="clip") <= b[other]) if len(b) else open_
        low = np.where(further, middle + 1, low)
        high = np.where(open_ & ~further, middle, high)
    return low, diagonal - low


def common_in_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both hold."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(b, a)
    same = np.flatnonzero(b.take(at, mode="clip") == a)
    return same, at[same]


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of their common values, piece by piece."""
    i, j = merge_path(a, b, work)
    left, right = [], []
    for i0, i1, j0, j1 in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()):
        x, y = common_in_piece(a[i0:i1], b[j0:j1])
        left.append(x + i0)
        right.append(y + j0)
        if i1 and j1 < len(b) and a[i1 - 1] == b[j1]:  # stitch: the cut lies between the two ends
            left.append(np.array([i1 - 1]))
            right.append(np.array([j1]))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _sum_by(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


class Aligner:
    """Groups and links of batches of documents."""

    def __init__(self, a: ByteSide, b: PieceSide):
        self.a, self.b = a, b
        self.length_a = np.array([len(t) for t in a.bytes], np.int64)
        self.length_b = np.array([len(t) for t in b.bytes], np.int64)
        self.shift = (len(b.bytes) - 1).bit_length()
        self.doc_shift = self.shift + (len(a.bytes) - 1).bit_length()
        # written form of a token: id and what follows it (last in its group or not)
        self.written = ([b"%d%c" % (i, c) for i in range(len(a.bytes)) for c in b",|"]
                        + [b"%d%c" % (i, c) for i in range(len(b.bytes)) for c in b",;"])

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text or SPACE in text:
            return None
        raw = b" " + text.encode()
        a, b = self.a.ids(text), self.b.ids(text)
        for ids, tokens, lengths in ((a, self.a.bytes, self.length_a), (b, self.b.bytes, self.length_b)):
            if int(lengths[ids].sum()) != len(raw) or b"".join(map(tokens.__getitem__, ids.tolist())) != raw:
                return None
        return a, b

    def align(self, encoded: list[tuple[np.ndarray, np.ndarray]]) -> dict:
        """For a batch: tokens, groups and links per document, the written
        groups, and (document << doc_shift | pair) keys with their links."""
        n_a = np.array([len(a) for a, _ in encoded], np.int64)
        n_b = np.array([len(b) for _, b in encoded], np.int64)
        a = np.concatenate([a for a, _ in encoded])
        b = np.concatenate([b for _, b in encoded])
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a, last_b = common_ends(end_a, end_b)  # of each group; a document's end is one
        first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
        p, q = last_a - first_a + 1, last_b - first_b + 1
        doc = np.searchsorted(np.cumsum(n_a), first_a, side="right")
        n_groups = np.bincount(doc, minlength=len(encoded))
        n_links = np.zeros(len(encoded), np.int64)
        np.add.at(n_links, doc, p * q)
        keys, links = self._pairs(a, b, first_a, first_b, p, q, doc)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                "groups": self._written(a, b, p, q, n_a + n_b), "keys": keys, "links": links}

    def _written(self, a, b, p, q, tokens) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        group_a, group_b = np.repeat(np.arange(len(p)), p), np.repeat(np.arange(len(q)), q)
        final_a, final_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        final_a[np.cumsum(p) - 1] = 1
        final_b[np.cumsum(q) - 1] = 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (np.cumsum(q) - q)[group_a]] = 2 * a + final_a
        codes[np.arange(len(b)) + np.cumsum(p)[group_b]] = 2 * (len(self.a.bytes) + b) + final_b
        out, at = [], 0
        for n in tokens.tolist():
            out.append(b"".join(map(self.written.__getitem__, codes[at:at + n].tolist()))[:-1])
            at += n
        return out

    def _pairs(self, a, b, first_a, first_b, p, q, doc) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, pair) keys and their numbers of links."""
        links = p * q
        found: list[tuple[np.ndarray, np.ndarray]] = []
        small = np.flatnonzero(links <= FULL_GROUP)
        steps = np.cumsum(links[small])
        edges = np.unique(np.searchsorted(steps, np.arange(0, (steps[-1] if len(steps) else 0) + PAIRS_AT_ONCE,
                                                           PAIRS_AT_ONCE), side="right"))
        for x, y in zip(np.append(0, edges), np.append(edges, len(small))):
            g = small[x:y]
            if len(g):
                of = np.repeat(np.arange(len(g)), links[g])
                k = np.arange(len(of)) - (np.cumsum(links[g]) - links[g])[of]
                i, j = first_a[g][of] + k // q[g][of], first_b[g][of] + k % q[g][of]
                keys = doc[g][of] << self.doc_shift | a[i] << self.shift | b[j]
                found.append(_sum_by(keys, np.ones(len(keys), np.int64)))
        for g in np.flatnonzero(links > FULL_GROUP):
            ids_a, times_a = np.unique(a[first_a[g]:first_a[g] + p[g]], return_counts=True)
            ids_b, times_b = np.unique(b[first_b[g]:first_b[g] + q[g]], return_counts=True)
            rows = max(1, PAIRS_AT_ONCE // len(ids_b))
            for r in range(0, len(ids_a), rows):
                keys = doc[g] << self.doc_shift | ids_a[r:r + rows, None] << self.shift | ids_b[None, :]
                found.append((keys.ravel(), (times_a[r:r + rows, None] * times_b[None, :]).ravel()))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(found) == 1:
            return found[0]
        return _sum_by(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


# Rows of the written table: a segment's documents, its distinct pairs with
# the number of its documents that hold them, and per document the pairs (as
# places in that list) with their links.
SEGMENT = ("seg long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
           "n_links array<long>, groups_sha256 array<string>, groups array<string>, sizes array<long>, "
           "pairs array<long>, holders array<long>, places binary, links binary")


def _packed(values: np.ndarray) -> bytes:
    """Numbers as byte planes: the upper ones are nearly constant."""
    return zstandard.ZstdCompressor(3).compress(
        np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel()


class _SegmentBuilder:
    def __init__(self, aligner: Aligner, with_groups: bool):
        self.aligner, self.with_groups = aligner, with_groups
        self.clear()

    def clear(self) -> None:
        self.bytes = self.batch_bytes = 0
        self.doc_ids: list = []
        self.per_doc: list[tuple] = []
        self.batch: list[tuple] = []      # places in per_doc, ids of both sides
        self.found: list[tuple] = []      # place in per_doc << doc_shift | pair, links

    def add(self, doc, raw: bytes) -> None:
        self.doc_ids.append(doc)
        self.per_doc.append((0, 0, 0, 0, "", ""))
        pair = self.aligner.encode(raw.decode() if raw else None)
        self.bytes += len(raw or b"") + 64
        if pair:
            self.batch.append((len(self.per_doc) - 1, *pair))
            self.batch_bytes += len(raw)
            if self.batch_bytes >= BATCH_BYTES:
                self.flush()

    def flush(self) -> None:
        if not self.batch:
            return
        got = self.aligner.align([b[1:] for b in self.batch])
        places = np.array([b[0] for b in self.batch], np.int64)
        for n, place in enumerate(places.tolist()):
            text = got["groups"][n]
            self.per_doc[place] = (int(got["n_a"][n]), int(got["n_b"][n]), int(got["n_groups"][n]),
                                   int(got["n_links"][n]), hashlib.sha256(text).hexdigest(),
                                   text.decode() if self.with_groups else "")
        shift = self.aligner.doc_shift
        self.found.append((places[got["keys"] >> shift], got["keys"] & ((1 << shift) - 1), got["links"]))
        self.batch, self.batch_bytes = [], 0

    def row(self, seg: int) -> dict:
        self.flush()
        doc, pair, links = (np.concatenate([f[i] for f in self.found]) if self.found else np.empty(0, np.int64)
                            for i in range(3))
        pairs, places, holders = np.unique(pair, return_inverse=True, return_counts=True)
        cols = list(zip(*self.per_doc))
        out = {"seg": seg, "doc_ids": self.doc_ids, **dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                                                               "groups"), map(list, cols))),
               "sizes": np.bincount(doc, minlength=len(self.doc_ids)).tolist(),  # documents come in order
               "pairs": pairs, "holders": holders, "places": _packed(places), "links": _packed(links)}
        self.clear()
        return out


def alignments(docs: DataFrame, tokenizer: str, model: str, ranks: str | None = None, pattern: str | None = None,
               with_groups: bool = False) -> DataFrame:
    """Rows of :data:`SEGMENT`, written to the shared folder; ``with_groups``
    keeps the groups themselves beside their digest."""
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        seg = TaskContext.get().partitionId() << 32
        builder = _SegmentBuilder(Aligner(ByteSide(tokenizer, ranks, pattern), PieceSide(model)), with_groups)
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                builder.add(doc, value.as_py())
                if builder.bytes >= SEGMENT_BYTES:
                    yield _record(builder.row(seg))
                    seg += 1
        if builder.doc_ids:
            yield _record(builder.row(seg))

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .mapInArrow(lean(work), SEGMENT), "alignments")


def _record(row: dict) -> pa.RecordBatch:
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    types = {"seg": pa.int64(), "groups_sha256": texts, "groups": texts, "places": pa.binary(), "links": pa.binary()}
    names = [c.split()[0] for c in SEGMENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[n]], types.get(n, longs)) for n in names], names)


def pair_counts(segments: DataFrame, shift: int) -> DataFrame:
    """pair, a_id, b_id, n_docs, highest (of its a_id) over the corpus."""
    held = segments.select(F.explode(F.arrays_zip("pairs", "holders")).alias("e"))
    counts = held.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.holders").alias("n_docs"))
    counts = written(counts.select("pair", F.shiftright("pair", shift).alias("a_id"),
                                   F.col("pair").bitwiseAND((1 << shift) - 1).alias("b_id"), "n_docs"), "pair-counts")
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("highest"))
    return counts.join(most, "a_id").select("pair", "a_id", "b_id", "n_docs", "highest")


def link_statistics(segments: DataFrame, shift: int) -> DataFrame:
    """Per document: tokens, groups, links, and what its pairs count."""
    counts = pair_counts(segments, shift)
    asked = segments.select("seg", F.posexplode("pairs").alias("place", "pair"))
    answers = (asked.join(counts, "pair").groupBy("seg")
               .agg(F.sort_array(F.collect_list(F.struct("place", "n_docs", "highest"))).alias("answer"))
               .select("seg", F.col("answer.n_docs").alias("n_docs"),
                       F.transform("answer", lambda s: s["n_docs"] == s["highest"]).alias("best")))
    rows = segments.drop("pairs", "holders").join(answers.hint("shuffle_hash"), "seg", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].as_py()  # noqa: E731, B023
                value = lambda name: batch.column(name)[i].values  # noqa: E731, B023
                sizes = np.array(get("sizes"), np.int64)
                sums = np.zeros((2, len(sizes)), np.int64)
                if sizes.sum():
                    places, links = _unpacked(get("places")), _unpacked(get("links"))
                    doc = np.repeat(np.arange(len(sizes)), sizes)
                    best = value("best").to_numpy(zero_copy_only=False)
                    np.add.at(sums[0], doc, links * best[places])
                    np.add.at(sums[1], doc, links * value("n_docs").to_numpy()[places])
                cols = [value(n) for n in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
                cols += [pa.array(sums[0]), pa.array(sums[1]), value("groups_sha256"), value("groups")]
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in ALIGNED.split(", ")])

    return rows.mapInArrow(lean(work), ALIGNED)


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, groups string")


def align_documents(docs: DataFrame, tokenizer: str, model: str, ranks: str | None = None,
                    pattern: str | None = None, with_groups: bool = False) -> DataFrame:
    """One row of :data:`ALIGNED` per document; ``groups`` is empty unless
    asked for."""
    import sentencepiece
    shift = (sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size() - 1).bit_length()
    segments = alignments(docs, tokenizer, model, ranks, pattern, with_groups)
    return link_statistics(segments, shift)
