"""Spelling variants of a corpus' words by permuterm rotations.

Words are counted first (partial counts in every task).  A word is marked
with a terminator and rotated to every place; two words that differ by one
replaced code point agree on the rotation that puts the edited place last, up
to that place, and a word that lacks the code point *is* that prefix.  So
every word emits, per code point, the rotation without it (key: prefix, the
skipped code point beside it), and per gap the whole rotation.  The rotations
are sorted and groups of equal prefixes are scanned: members that skipped
differ by a replacement, the member that skipped nothing lacks one code point
of each.  Deleting any code point of a run of equal ones gives the same word,
so only the first of a run counts there and no pair meets twice.

A group has at most one member per letter of the alphabet and one more,
whatever the corpus, so no key is hot; a group emits its members with their
number of neighbours and the best of them, never its pairs.

Words of more than ``LITERAL`` code points would make rotations of quadratic
size.  Their prefixes travel as 124-bit polynomial hashes, computed for all
rotations from one prefix sum, and the few pairs that meet are verified on
the words themselves.

The most frequent near word is a word's *form* if it is ``ratio`` times as
frequent.  Counts grow by that factor along a chain of forms, so a few rounds
of pointer doubling, their number known from the largest count, find every
root.

Defined results: a null or empty text has no words; a null ``doc_id`` is
written as nothing in the noise hash; repeated rows count again; a table
without words gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import lean, prepare, written

TERMINATOR = "$"   # no letter
LITERAL = 64       # longest word whose rotations are written out
FLUSH = 200_000    # distinct words a task holds before it emits counts
CHUNK = 1 << 22
WHOLE, FIRST, LATER = 0, 1, 2  # nothing skipped; first, later of a run of equal code points
HASHES = ((2147483647, 48271), (2147483629, 69621), (2147483587, 40692), (2147483579, 39373))


def count_words(docs: DataFrame, shortest: int = 7, least: int = 2, noise: int | None = 31) -> DataFrame:
    """word, n over all documents.  Words are maximal runs of Latin-1 letters
    with A-Z lower-cased.  ``noise``: where it divides the unsigned crc32 of
    ``<doc_id>:<run>``, the code point at that hash modulo the length goes."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % shortest)

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                           pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in _runs(runs, value.as_py() or b"").items():
                    if noise and not (h := zlib.crc32(run.encode(), seed)) % noise:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < shortest:
                            continue
                    total[run] += n
                if len(total) >= FLUSH:
                    yield emit(total)
                    total = Counter()
        yield emit(total)

    partial = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(lean(count), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _runs(pattern: re.Pattern, raw: bytes) -> Counter:
    """Lower-cased (A-Z) runs of a UTF-8 text, a few megabytes at a time."""
    found: Counter = Counter()
    a = 0
    while a < len(raw):
        b = a + CHUNK
        while b < len(raw) and (raw[b] >= 0x80 or chr(raw[b]).isalpha()):  # between runs, so between code points
            b += 1
        found.update(pattern.findall(raw[a:b].lower().decode()))
        a = b
    return found


def rotations(word: str) -> Iterator[tuple[str, str, int]]:
    """(prefix, skipped code point, kind) of every rotation of word + $."""
    marked = word + TERMINATOR
    for i, c in enumerate(word):
        yield marked[i + 1:] + word[:i], c, FIRST if not i or word[i - 1] != c else LATER
    for i in range(len(marked)):
        yield marked[i:] + word[:i], "", WHOLE


def unrotated(prefix: str, skipped: str) -> str:
    tail, _, head = prefix.partition(TERMINATOR)
    return head + skipped + tail


def rotation_hashes(word: str) -> tuple[np.ndarray, np.ndarray]:
    """124-bit hashes (two uint64 columns) of the prefixes of
    :func:`rotations`: first those that skip, then the whole ones."""
    marked = np.frombuffer((word + TERMINATOR).encode("utf-32-le"), "<u4").astype(np.uint64)
    m = len(marked) - 1
    out = []
    for modulus, base in HASHES:
        p = np.uint64(modulus)
        power = np.ones(2 * m + 2, np.uint64)   # powers of the base, by doubling
        done = 1
        while done < len(power):
            more = min(done, len(power) - done)
            power[done:done + more] = power[:more] * np.uint64(pow(base, done, modulus)) % p
            done += more
        twice = np.concatenate((marked, marked))[:2 * m + 1]
        # suffix-aligned prefix sums: h(x, y) = sum of twice[k] * base^(y - 1 - k)
        inverse = pow(base, -1, modulus)
        down = np.ones(2 * m + 2, np.uint64)
        done = 1
        while done < len(down):
            more = min(done, len(down) - done)
            down[done:done + more] = down[:more] * np.uint64(pow(inverse, done, modulus)) % p
            done += more
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(twice % p * down[:len(twice)] % p)))

        def h(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return (sums[y] - sums[x]) % p * power[y - 1] % p  # noqa: B023

        i = np.arange(m)
        skip = h(i + 1, i + 1 + m)              # marked[i + 1:] + word[:i], m code points
        j = np.arange(m + 1)
        whole = h(j, j + m + 1)                 # a whole rotation, m + 1 code points
        out.append(np.concatenate((skip, whole)))
    return out[0] << np.uint64(31) | out[1], out[2] << np.uint64(31) | out[3]


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[list]]:
    """The columns of each group of two or more rows with equal keys; rows
    come sorted by their keys, the first ``n_keys`` columns."""
    held: pa.RecordBatch | None = None
    for batch in itertools.chain((b for b in batches if b.num_rows), [None]):
        if batch is not None:
            held = batch if held is None else pa.concat_batches([held, batch])
        if held is None or not held.num_rows:
            continue
        new = np.zeros(held.num_rows, bool)
        new[0] = True
        for k in range(n_keys):
            col = held.column(k)
            new[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        start = np.flatnonzero(new)
        whole = len(start) if batch is None else len(start) - 1  # the last group may go on
        end = np.append(start[1:], held.num_rows)[:whole]
        start = start[:whole]
        several = np.flatnonzero(end - start > 1)
        if len(several):
            sizes = (end - start)[several]
            at = np.repeat(start[several], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            cols = [c.to_pylist() for c in held.take(pa.array(at)).columns]
            a = 0
            for size in sizes.tolist():
                yield [c[a:a + size] for c in cols]
                a += size
        held = held.slice(int(end[-1])) if whole else held


NEAR = "word string, n_near long, near_n long, near_word string"


def _better(n: int, word: str) -> tuple[int, bytes]:
    return -n, word.encode()


def near_words(words: DataFrame) -> DataFrame:
    """Rows of :data:`NEAR`: for each word that has near words, how many, and
    the most frequent of them (ties: smallest in code-point order).  ``words``
    (word, n) is a written table of distinct words."""
    parts = [_near_literal(words), _near_hashed(words)]
    both = parts[0].union(parts[1])
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near_word"))
    return (both.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.order")).alias("near_n"), F.col("best.near_word")))


def _near_literal(words: DataFrame) -> DataFrame:
    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for prefix, skipped, kind in rotations(word):
                    cols[0].append(prefix)
                    cols[1].append(skipped)
                    cols[2].append(kind)
                    cols[3].append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                ["prefix", "skipped", "kind", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], []]
        for prefixes, skipped, kinds, counts in _groups(batches, 1):
            members = sorted((_better(n, word), word, kind, n) for n, kind, word in (
                (n, kind, unrotated(prefixes[0], c)) for c, kind, n in zip(skipped, kinds, counts)))
            first = sum(kind == FIRST for _, _, kind, _ in members)
            whole = any(kind == WHOLE for _, _, kind, _ in members)
            for i, (_, word, kind, _) in enumerate(members):
                n_near = first if kind == WHOLE else len(members) - 1 - (whole and kind == LATER)
                if n_near:
                    near = next(m for j, m in enumerate(members) if j != i and (
                        {kind, m[2]} != {WHOLE, LATER}))
                    for col, value in zip(out, (word, n_near, near[3], near[1])):
                        col.append(value)
            if len(out[0]) >= 4096:
                yield _near_batch(out)
                out = [[], [], [], []]
        yield _near_batch(out)

    rows = (words.where(F.length("word") <= LITERAL).select("word", "n")
            .mapInArrow(lean(rotate), "prefix string, skipped string, kind int, n long"))
    return rows.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(lean(scan), NEAR)


def _near_batch(cols: list[list]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["word", "n_near", "near_n", "near_word"])


def _near_hashed(words: DataFrame) -> DataFrame:
    """The same for long words; words of exactly ``LITERAL`` code points take
    part with their whole rotations, to meet those one longer."""
    long_words = words.where(F.length("word") >= LITERAL).select("word", "n", F.sha2("word", 256).alias("id"))

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, key in zip(*(c.to_pylist() for c in batch.columns)):
                high, low = rotation_hashes(word)
                points = np.array(list(word + TERMINATOR))
                kind = np.concatenate((np.where(np.append(True, points[1:-1] != points[:-2]), FIRST, LATER),
                                       np.full(len(word) + 1, WHOLE)))
                begin = 0 if len(word) > LITERAL else len(word)
                for a in range(begin, len(kind), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    n = len(kind[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(high[part].view(np.int64)), pa.array(low[part].view(np.int64)),
                         pa.array([key] * n, pa.string()), pa.array(kind[part].astype(np.int32))],
                        ["high", "low", "id", "kind"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], []]
        for _, _, ids, kinds in _groups(batches, 2):
            for i, (x, kind) in enumerate(zip(ids, kinds)):
                for y, other in zip(ids[i + 1:], kinds[i + 1:]):
                    if x != y and {kind, other} not in ({WHOLE, LATER}, {WHOLE}):
                        out[0] += (x, y)
                        out[1] += (y, x)
            if len(out[0]) >= 4096:
                yield _pair_batch(out)
                out = [[], []]
        yield _pair_batch(out)

    keys = long_words.select("word", "id").mapInArrow(lean(rotate), "high long, low long, id string, kind int")
    pairs = (keys.repartition("high", "low").sortWithinPartitions("high", "low")
             .mapInArrow(lean(scan), "id string, other string").distinct())
    other = long_words.select(F.col("id").alias("other"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return (pairs.join(long_words, "id").join(other, "other")
            .where(F.levenshtein("word", "near_word", 1) == 1)
            .select("word", F.lit(1).cast("long").alias("n_near"), "near_n", "near_word"))


def _pair_batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["id", "other"])


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words``
    (word, n; distinct words)."""
    prepare(words.sparkSession)
    words = written(words.select("word", "n"), "words")
    near = near_words(words)
    is_form = F.col("near_n") >= ratio * F.col("n")
    rows = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near_word")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "near-words")
    most = rows.agg(F.max("n")).first()[0] or 1
    longest_chain = int(math.log(most, ratio)) + 1
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest_chain)) if longest_chain > 1 else 0):
        jump = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = written(roots.join(jump, "root", "left")
                        .select("word", F.coalesce("further", "root").alias("root")), "roots")
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10,
                    noise: int | None = 31) -> DataFrame:
    """:func:`variants` of the words of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    return variants(count_words(docs, shortest, least, noise), ratio)
