"""Document fingerprints as Merkle trees, with DataFrame functions only.

A text is cut into sections (at blank lines) and these into paragraphs (at
line ends).  A paragraph's digest is the SHA-256 of its text, a section's of
its paragraphs' digests, the root of the sections' digests: equal texts have
equal roots, and from two unequal roots the differing branches lead to the
edited paragraphs (:func:`locate_edits`).  Under a paragraph hang its leaves,
pieces of up to ``LEAF_WORDS`` words of a sentence.

:func:`likeness` compares two trees.  A node's digest stands for all that is
below it, so the nodes that two trees share (the same level and digest) are
the branches that a walk from both roots need not enter and, inside those it
does enter, what it finds again.  Twice the shared nodes over the nodes of
both is 1 for equal roots and only for them, as a changed leaf changes every
node above it; half a text replaced leaves about the nodes of the other half.

Defined results: a null text is empty; an empty text is one empty paragraph;
repeated rows are fingerprinted one by one; rows without an id come first in
the order of ids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter.llm.common import prepare

SECTION_BREAK = r"\n\n"
PARAGRAPH_BREAK = r"\n"
SENTENCE_BREAK = r"(?<=[.!?]) |\n"
LEAF_WORDS = 2
LEAF = r"(?:\S+\s*){1,%d}" % LEAF_WORDS


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def tree(text: Column) -> Column:
    """array<struct<digest, paragraphs array<digest>>>, one entry per section."""
    paragraphs = F.transform(
        F.split(text, SECTION_BREAK, -1),
        lambda s: F.transform(F.split(s, PARAGRAPH_BREAK, -1), lambda p: F.sha2(p, 256)))
    return F.transform(paragraphs, lambda ps: F.struct(_digest(ps).alias("digest"), ps.alias("paragraphs")))


def root(tree_col: Column) -> Column:
    """The fingerprint: 64 hex digits."""
    return _digest(tree_col["digest"])


def nodes(text: Column, tree_col: Column) -> Column:
    """64-bit names of the distinct nodes of a text's tree: root, sections,
    paragraphs and leaves, each level with a mark of its own."""
    named = lambda level, digest: F.xxhash64(F.lit(level), digest)
    paragraphs = F.flatten(F.transform(tree_col, lambda s: F.transform(s["paragraphs"], lambda p: named(2, p))))
    sections = F.transform(tree_col, lambda s: named(1, s["digest"]))
    leaves = F.flatten(F.transform(F.split(text, SENTENCE_BREAK, -1), lambda s: F.transform(
        F.regexp_extract_all(s, F.lit(LEAF), F.lit(0)), lambda leaf: named(3, leaf))))
    return F.array_distinct(F.concat(F.array(named(0, root(tree_col))), sections, paragraphs, leaves))


def likeness(left: Column, right: Column) -> Column:
    """Of two arrays of node names, 0 to 1."""
    return 2.0 * F.size(F.array_intersect(left, right)) / (F.size(left) + F.size(right))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, fingerprint."""
    text = F.coalesce("text", F.lit(""))
    return (docs.select("doc_id", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("fingerprint", root(tree(F.col("text")))))


def locate_edits(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Adds ``equal`` and ``edits`` to rows that hold two texts: section and
    paragraph (from 0) of every paragraph that differs or is in one only;
    sections with equal digests are not looked into."""
    both = (pairs.withColumn("_l", tree(F.coalesce(left, F.lit(""))))
            .withColumn("_r", tree(F.coalesce(right, F.lit("")))))
    at = F.sequence(F.lit(0), F.greatest(F.size("_l"), F.size("_r")) - 1)

    def section(i: Column) -> Column:
        a, b = F.get(F.col("_l"), i), F.get(F.col("_r"), i)
        none = F.array().cast("array<string>")
        pa, pb = F.coalesce(a["paragraphs"], none), F.coalesce(b["paragraphs"], none)
        inside = F.filter(F.sequence(F.lit(0), F.greatest(F.size(pa), F.size(pb)) - 1),
                          lambda j: ~F.get(pa, j).eqNullSafe(F.get(pb, j)))
        return F.when(a["digest"].eqNullSafe(b["digest"]), F.array().cast(
            "array<struct<section:int,paragraph:int>>")).otherwise(
            F.transform(inside, lambda j: F.struct(i.alias("section"), j.alias("paragraph"))))

    return (both.withColumn("equal", root(F.col("_l")) == root(F.col("_r")))
            .withColumn("edits", F.flatten(F.transform(at, section))).drop("_l", "_r"))


def id_buckets(docs: DataFrame, rows_per_bucket: int = 64, max_cells: int = 1 << 18) -> tuple[Column, DataFrame]:
    """Consecutive ranges of ``doc_id``: the cell of a row, and the table
    cell, bucket, first_id, before (the bucket that comes before, in a ring).

    Cells are slices of one width.  Where slices of the whole range would do,
    smaller ones (64 times at a step) are tried by counting those that have
    rows, so a few ids far off do not widen the others'; there is one for
    64 rows, and at most ``max_cells`` of them, so the table stays small
    enough to broadcast whatever the input.  Neighbouring cells make a bucket of about
    ``rows_per_bucket`` rows."""
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    cells = min(max_cells, max(1024, n // 64))
    width = 1 if low is None else (high - low) // cells + 1
    finer = [width // 64 ** i for i in range(1, 11) if width >= 64 ** i]
    if finer:
        found = docs.agg(*[F.approx_count_distinct(F.expr(f"doc_id div {w}L")) for w in finer]).first()
        width = min([width, *(w for w, n in zip(finer, found) if n <= 0.8 * cells)])
    cell = F.coalesce(F.expr(f"doc_id div {width}L"), F.lit(-(1 << 62)))   # rows without an id first
    counts = docs.select("doc_id", cell.alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id")).alias("first"))   # in a struct a null is the smallest
    running = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counts.withColumn("bucket", F.floor((F.sum("n").over(running) - F.col("n")) / rows_per_bucket))
    firsts = numbered.groupBy("bucket").agg(F.min("first")["doc_id"].alias("first_id"))
    ring = Window.orderBy("bucket")
    last = F.max("bucket").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.withColumn("before", F.coalesce(F.lag("bucket").over(ring), last))
    return cell, numbered.select("cell", "bucket").join(firsts, "bucket")


def with_next(prints: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds ``next_text``, the text of the document with the next
    larger id (the last one: of the first; of equal ids, by size and root).

    Texts move once: a bucket of consecutive ids is one window, and the first
    document of a bucket is also sent to the bucket before."""
    cell, buckets = id_buckets(docs)
    rows = prints.withColumn("cell", cell).join(F.broadcast(buckets), "cell")
    seats = F.when(F.col("doc_id").eqNullSafe(F.col("first_id")), F.array(
        F.struct(F.col("bucket"), F.lit(False).alias("guest")),
        F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest"))))
    rows = rows.withColumn("seat", F.explode(seats)).select(
        *prints.columns, F.col("seat.bucket").alias("bucket"), F.col("seat.guest").alias("guest"))
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "n_chars", "fingerprint")
    return (rows.withColumn("next_text", F.lead("text").over(order))
            .where(~F.col("guest")).drop("bucket", "guest"))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text (its last half replaced by
    the start of the next document) and their likeness."""
    prepare(docs.sparkSession)
    half = F.expr("n_chars div 2").cast("int")
    rows = with_next(fingerprints(docs), docs.select("doc_id"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring("next_text", F.lit(1), half)))
    # trees are built where the texts have met: their nodes need not travel.
    # Each is a column of its own, or every use would build it again
    for name, text in (("own", "text"), ("new", "edited"), ("after", "next_text")):
        rows = rows.withColumn(f"{name}_tree", tree(F.col(text)))
    for name, text in (("own", "text"), ("new", "edited"), ("after", "next_text")):
        rows = rows.withColumn(f"{name}_nodes", nodes(F.col(text), F.col(f"{name}_tree")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        root(F.col("new_tree")).alias("edited_fingerprint"),
        likeness(F.col("own_nodes"), F.col("new_nodes")).alias("near_edited"),
        likeness(F.col("own_nodes"), F.col("after_nodes")).alias("near_next"))
