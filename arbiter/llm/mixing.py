"""Mixing sources to target weights, with DataFrame functions only.

1. Words per document are counted and summed per source; targets follow by
   water-filling (weights share the mix, a source stops at ``max_repeat``
   times its size, the excess goes to the others by weight).
2. Inside a source the documents, in id order, form one row of words that is
   cut into blocks of ``block`` words; the last, shorter block is its tail.
3. A source's quota of word slots is its target: whole passes over the source
   plus part of one.  Its slots are thrown on the output shards independently
   and uniformly, which draws the multinomial counts (shard, source) given
   the quotas; each shard then owns consecutive slot numbers of each source.
4. A slot number becomes a pass and an index inside the pass.  The source's
   full blocks are permuted by ranking them by a keyed hash, the tail comes
   last; a block's rank is its index, and slots are joined to blocks by
   (source, index).  Document pieces hang on their blocks.

No window or group holds a whole source: prefix sums run inside buckets of
documents and over the bucket totals.  Everything is a function of the rows
and ``seed``, so reruns agree.

Defined results: a null text has size 0 and is never taken; the null source
is a source (last in order); repeated rows are separate documents; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbiter.llm.common import WORD_PATTERN, parts_for, prepare, shuffle_partitions, written

WEIGHTS = (5, 2, 1)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sized(docs: DataFrame, row: str | None = None, rows_per_bucket: int = 4096, seed: int = 7) -> DataFrame:
    """doc_id, source, row (a column that numbers the rows, or a hash of the
    text), size and ``start``: the words of its source before it.

    The bucket of a document is a hash of its id, so a hot source spreads
    over all buckets; documents of a source are laid out bucket by bucket."""
    base = docs.select("doc_id", "source", (F.col(row) if row else F.xxhash64("text")).alias("row"),
                       word_count().alias("size"))
    n = parts_for(docs.count(), rows_per_bucket, 64)
    base = written(base.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(n))), "sizes")
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = base.withColumn("upto", F.sum("size").over(inside))
    return (_after_buckets(rows, base.groupBy("source", "bucket").agg(F.sum("size").alias("amount")))
            .select("doc_id", "source", "row", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("start")))


def _after_buckets(rows: DataFrame, amounts: DataFrame) -> DataFrame:
    """Adds ``before``: the amount in a source's buckets before a row's own."""
    before = amounts.select(
        F.col("source").alias("t_source"), F.col("bucket").alias("t_bucket"),
        (F.sum("amount").over(Window.partitionBy("source").orderBy("bucket")) - F.col("amount")).alias("before"))
    return rows.join(before, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("bucket") == F.col("t_bucket"))
                     ).drop("t_source", "t_bucket")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
            max_repeat: int = 2) -> DataFrame:
    """source, source_size, weight, target: water-filling over the sources.

    Sources by the level at which they fill up (``max_repeat`` x size /
    weight): a source is full exactly if its level does not exceed what the
    rest of the mix gives per weight to it and all later ones.  The table has
    one row per source, so these windows run over a summary."""
    rank = Window.orderBy(F.asc_nulls_last("source"))
    by_source = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                 .withColumn("no", F.row_number().over(rank) - 1))
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int"))
    fill = Window.orderBy("level", "no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("level", "no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = F.lit(max_repeat) * F.col("source_size")
    out = (by_source.withColumn("weight", pick)
           .withColumn("level", cap / F.col("weight"))
           .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
           .withColumn("left", F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
           .withColumn("per_weight", F.col("left") / F.sum("weight").over(rest))
           .withColumn("full", F.col("level") <= F.col("per_weight")))
    # the first source that is not full sets the water level of all later ones
    water = F.first(F.when(~F.col("full"), F.col("per_weight")), ignorenulls=True).over(everything)
    return out.withColumn("water", water).select(
        "source", "source_size", "weight",
        F.when(F.col("full"), cap.cast("double")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def pieces(laid: DataFrame, goals: DataFrame, block: int, seed: int, blocks_per_bucket: int = 4096) -> DataFrame:
    """The words [a, b) of a document that stand in a block, from ``at`` in
    the block, and the block's ``index`` in the permutation of its source."""
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    n = parts_for(total // block, blocks_per_bucket, 64)
    sources = goals.select(F.col("source").alias("g_source"), F.expr(f"source_size div {block}").alias("full"))
    blk = F.col("blk")
    rows = (laid.where("size > 0").join(sources, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
            .withColumn("blk", F.explode(F.sequence(
                F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
            .withColumn("a", F.greatest(F.col("start"), blk * block) - F.col("start"))
            .withColumn("b", F.least(F.col("start") + F.col("size"), (blk + 1) * block) - F.col("start"))
            .withColumn("at", F.col("start") + F.col("a") - blk * block)
            .withColumn("draw", F.xxhash64("source", "blk", F.lit(seed)))
            # the tail stands alone behind all buckets
            .withColumn("bucket", F.when(blk < F.col("full"), F.pmod("draw", F.lit(n))).otherwise(F.lit(n))))
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "blk")
    rows = written(rows.withColumn("rank", F.dense_rank().over(inside)), "pieces")
    return (_after_buckets(rows, rows.groupBy("source", "bucket").agg(F.max("rank").cast("long").alias("amount")))
            .withColumn("index", F.col("before") + F.col("rank") - 1)
            .drop("draw", "bucket", "rank", "before", "full", "blk"))


def slots(quota: DataFrame, block: int, seed: int, slots_per_shard: int, chunk: int = 4096) -> DataFrame:
    """Output slots: shard, source, slot, pass, index, ``may`` (the words it
    may take of its block).

    ``quota``: source, source_size, quota (words).  The counts per (shard,
    source) are drawn slot by slot and pre-aggregated; slot numbers follow
    from their running sum."""
    spark = quota.sparkSession
    q = (quota.where("quota > 0")
         .withColumn("per_pass", F.ceil(F.col("source_size") / block))
         .withColumn("passes", F.expr("quota div source_size"))
         .withColumn("rest", F.col("quota") % F.col("source_size"))
         .withColumn("n_slots", F.col("passes") * F.col("per_pass") + F.ceil(F.col("rest") / block)))
    q = written(q, "quota")
    shards = parts_for(q.agg(F.sum("n_slots")).first()[0] or 1, slots_per_shard)
    dealt = lambda df, *keys: df.repartition(shuffle_partitions(spark), *keys)
    chunks = q.select("source", "n_slots", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(n_slots - 1) div {chunk}"))).alias("c"))
    throws = (dealt(chunks, "source", "c")
              .select("source", F.explode(F.sequence(
                  F.col("c") * chunk, F.least((F.col("c") + 1) * chunk, F.col("n_slots")) - 1)).alias("throw")))
    counts = (throws.select("source", F.pmod(F.xxhash64("source", "throw", F.lit(seed)), F.lit(shards)).alias("shard"))
              .groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n")))
    counts = counts.withColumn("upto", F.sum("n").over(
        Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    q = q.select(F.col("source").alias("q_source"), "per_pass", "passes", "rest")
    parts = (counts.join(q, F.col("source").eqNullSafe(F.col("q_source"))).drop("q_source")
             .withColumn("from", F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1, F.lit(chunk)))))
    whole = F.lit(block).cast("long")
    return (dealt(parts, "source", "from")
            .withColumn("slot", F.explode(F.sequence("from", F.least(F.col("from") + chunk, F.col("upto")) - 1)))
            .withColumn("pass", F.expr("slot div per_pass"))
            .withColumn("index", F.col("slot") % F.col("per_pass"))
            # the last slot of the broken pass is cut where the quota ends
            .withColumn("may", F.when(F.col("pass") < F.col("passes"), whole)
                        .otherwise(F.least(whole, F.col("rest") - F.col("index") * block)))
            .select("shard", "source", "slot", "pass", "index", "may"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_repeat: int = 2,
        block: int = 64, seed: int = 20, slots_per_shard: int = 16_384, row: str | None = None) -> dict[str, DataFrame]:
    """``documents`` (doc_id, source, size, start), ``targets``, ``slots`` and
    ``pieces``.  A slot takes a block's words before ``may``."""
    prepare(docs.sparkSession)
    laid = written(sized(docs, row), "laid")
    goals = written(targets(laid, weights, share, max_repeat).withColumn("quota", F.round("target").cast("long")),
                    "targets")
    return {"documents": laid, "targets": goals, "slots": slots(goals, block, seed, slots_per_shard),
            "pieces": pieces(laid, goals, block, seed)}


def taken(mixed: dict[str, DataFrame]) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken."""
    grouped = mixed["slots"].groupBy("source", "index").agg(F.collect_list("may").alias("takes"))
    # a block is in at most one slot a pass, so its list is as long as the passes
    hits = mixed["pieces"].join(
        # (the planner can't see how many slots the small quota table unfolds into)
        grouped.select(F.col("source").alias("s_source"), F.col("index").alias("s_index"), "takes").hint("merge"),
        F.col("source").eqNullSafe(F.col("s_source")) & (F.col("index") == F.col("s_index")))
    words = F.aggregate("takes", F.lit(0).cast("long"), lambda total, may: total + F.greatest(
        F.lit(0).cast("long"), F.least(F.col("b") - F.col("a"), may - F.col("at"))))
    per_doc = hits.groupBy("source", "start").agg(F.sum(words).alias("taken")).select(
        F.col("source").alias("h_source"), F.col("start").alias("h_start"), "taken")
    goals = mixed["targets"].select(F.col("source").alias("g_source"), "source_size", "target")
    return (mixed["documents"].join(goals, F.col("source").eqNullSafe(F.col("g_source")))
            .join(per_doc, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("start") == F.col("h_start"))
                  & (F.col("size") > 0), "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, mixed: dict[str, DataFrame], row: str) -> DataFrame:
    """The mix as rows with the columns of ``docs``, which :func:`mix` got
    with ``row``, a number of the row: a document appears once for every pass
    over its source that takes of it; text that is taken in part is cut to
    the words taken (joined by one space), and ``n_chars`` counted anew."""
    take = F.least(F.col("b") - F.col("a"), F.col("may") - F.col("at"))
    s = mixed["slots"].select(F.col("source").alias("s_source"), F.col("index").alias("s_index"), "pass", "may").hint("merge")
    # a document's pieces in one pass: as many as its blocks
    parts = (mixed["pieces"].join(s, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("index") == F.col("s_index")))
             .where(take > 0).groupBy("row", "size", "pass")
             .agg(F.sum(take).alias("words"),
                  F.sort_array(F.collect_list(F.struct("a", take.alias("n")))).alias("parts"))
             .withColumn("parts", F.when(F.col("words") < F.col("size"), F.col("parts"))))
    parts = parts.select(F.col("row").alias("_of"), "parts")
    joined = docs.join(parts.hint("merge"), F.col(row) == F.col("_of"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"))
    cut = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(
        F.col("_words"), (p["a"] + 1).cast("int"), p["n"].cast("int")))), " ")
    out = (joined.withColumn("_words", F.when(F.col("parts").isNotNull(), words))
           .withColumn("text", F.when(F.col("parts").isNull(), F.col("text")).otherwise(cut)).drop(row))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[c for c in docs.columns if c != row])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` mixed to the target weights.  The rows are written once with a
    number, on which their texts are found again."""
    prepare(docs.sparkSession)
    row = "_mixing_row"
    held = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    return mixed_documents(held, mix(held, row=row, **options), row)
