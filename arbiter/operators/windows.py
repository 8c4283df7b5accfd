"""Skew-tolerant ordered per-key computations.

A plain ``Window.partitionBy(key).orderBy(seq)`` puts every row of a key in
one task; a model or user that holds a third of the log would then be sorted
and scanned by a single core.  The helpers below split the ordering column
into ranges (integer division, so exact for any 64-bit value), do the
row-level window inside each (key, range), and carry the per-range totals
across ranges with a window over the summary, which has one row per (key,
range).  As the column is unique within a key, a range of width W holds at
most W rows of a key.  The width is the smallest of a few that leaves ranges
enough to a task, so dense numbers stay in ranges of ``ROWS_PER_RANGE`` even
where a few lie far off, and sparse ones are not a range each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1 << 20


def range_width(df: DataFrame, order: str, rows: int = ROWS_PER_RANGE) -> int:
    """Width of the ranges of ``order``: ``rows`` times the smallest power of
    64 by which the values fall into no more than 4 n / rows (at least 64)
    ranges; one aggregate."""
    widths = [rows * 64 ** i for i in range(8) if rows * 64 ** i < 1 << 62]
    found = df.agg(F.count(order), *[F.approx_count_distinct(F.expr(f"`{order}` div {w}L")) for w in widths]).first()
    most = max(64, 4 * found[0] // rows)
    return next((w for w, n in zip(widths, found[1:]) if n <= most), widths[-1])


def _bucket(order: str, width: int) -> Column:
    return F.expr(f"`{order}` div {width}L")


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, str],
                 width: int | None = None) -> DataFrame:
    """For each (out, value) of ``sums``: ``sum(value) over (partition by keys
    order by order rows unbounded..current)``, all in one pass.

    ``order`` must be an integer and unique within a key.
    """
    b = "_rs_bucket"
    x = df.withColumn(b, _bucket(order, width or range_width(df, order)))
    inside = (Window.partitionBy(*keys, b).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = x.select("*", *[F.sum(v).over(inside).alias(f"_rs_local_{out}") for out, v in sums.items()])
    totals = x.groupBy(*keys, b).agg(*[F.sum(v).alias(f"_rs_total_{out}") for out, v in sums.items()])
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, b, *[
        F.coalesce(F.sum(f"_rs_total_{out}").over(before), F.lit(0)).alias(f"_rs_offset_{out}") for out in sums])
    j = local.join(offsets, [*keys, b], "inner")
    for out in sums:
        j = j.withColumn(out, F.col(f"_rs_offset_{out}") + F.col(f"_rs_local_{out}")).drop(
            f"_rs_local_{out}", f"_rs_offset_{out}")
    return j.drop(b)


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str,
                width: int | None = None) -> DataFrame:
    """``sum(value) over (partition by keys order by order rows unbounded..current)``.

    ``order`` must be an integer and unique within a key.
    """
    return running_sums(df, keys, order, {out: value}, width)


def previous_value(df: DataFrame, keys: list[str], order: str, value: str, out: str,
                   width: int | None = None) -> DataFrame:
    """``lag(value) over (partition by keys order by order)``, skew-tolerant."""
    b = "_pv_bucket"
    x = df.withColumn(b, _bucket(order, width or range_width(df, order)))
    local = x.withColumn("_pv_local",
                         F.lag(value).over(Window.partitionBy(*keys, b).orderBy(order)))
    local = local.withColumn(
        "_pv_first", F.row_number().over(Window.partitionBy(*keys, b).orderBy(order)) == 1)
    last = x.groupBy(*keys, b).agg(F.max_by(value, order).alias("_pv_last"))
    carry = last.select(*keys, b, F.lag("_pv_last").over(
        Window.partitionBy(*keys).orderBy(b)).alias("_pv_carry"))
    j = local.join(carry, [*keys, b], "inner")
    return j.withColumn(out, F.when(F.col("_pv_first"), F.col("_pv_carry"))
                        .otherwise(F.col("_pv_local"))).drop(
        b, "_pv_local", "_pv_first", "_pv_carry")


def next_min(df: DataFrame, keys: list[str], order: str, value: str, out: str,
             width: int | None = None) -> DataFrame:
    """Smallest ``value`` among the later rows of the key, NULL if none has
    one.  Windows run backwards, so that each frame grows by one row."""
    b = "_nm_bucket"
    x = df.withColumn(b, _bucket(order, width or range_width(df, order)))
    later = Window.partitionBy(*keys, b).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = x.withColumn("_nm_local", F.min(value).over(later))
    carry = x.groupBy(*keys, b).agg(F.min(value).alias("_nm_min")).select(
        *keys, b, F.min("_nm_min").over(Window.partitionBy(*keys).orderBy(F.desc(b)).rowsBetween(
            Window.unboundedPreceding, -1)).alias("_nm_carry"))
    return (local.join(carry, [*keys, b]).withColumn(out, F.least("_nm_local", "_nm_carry"))
            .drop(b, "_nm_local", "_nm_carry"))
