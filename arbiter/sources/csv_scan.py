"""CSV files read as numbered lines, with types taken from every cell.

A scan has three results:

* ``types``: per column, the type that all its cells fit.  Each cell is of one
  kind (null, integer, number, boolean, date, timestamp, text); counts per
  (column, kind) are partial aggregates of the whole input, and the kinds of
  a column are joined in a lattice: integer below number, date below
  timestamp, everything below text.  A late float widens its column, however
  many integers came before it.  With ``tolerance`` above 0 a column keeps its
  type although that share of its cells, at most, does not fit it.
* ``rows``: the lines with typed cells, their file and line number, and
  ``rejected``: the cells that did not fit, which are NULL.  No row is dropped.
* ``rejects``: one row per cell that does not fit, with file, line, column,
  text and the type it missed; a line with another number of cells than the
  header is one reject with no column.  ``carry`` names columns whose typed
  cells a reject takes along, so that no join is needed to say what it is of.

Lines are numbered and cut into cells once and written; types, rows and
rejects are read from the cells.

Lines are numbered without a shuffle: a file is read in blocks, rows of a
block come in order, and the number of lines of earlier blocks is added (one
row per block, as many as the listing that the driver plans from).  A record
is one line: quoted cells must not hold line breaks.  Every file begins with
the same header; a file with another one is an error.  Empty lines are no
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arbiter.sources.materialize import checkpointed

# Chains of the lattice: kinds of a chain join to the type of the widest one.
CHAINS = ((("integer", "bigint"), ("number", "double")), (("boolean", "boolean"),),
          (("date", "date"), ("timestamp", "timestamp")))

_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DATE = r"^\s*\d{4}-\d{2}-\d{2}\s*$"
_TIMESTAMP = r"^\s*\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?\s*$"


def cell_kind(c: Column) -> Column:
    """The narrowest kind of a cell's text."""
    return (F.when(c.isNull(), "null")
            .when(c.rlike(_INTEGER) & c.try_cast("bigint").isNotNull(), "integer")
            .when(c.rlike(_NUMBER), "number")
            .when(F.lower(F.trim(c)).isin("true", "false"), "boolean")
            .when(c.rlike(_DATE) & c.try_cast("date").isNotNull(), "date")
            .when(c.rlike(_TIMESTAMP) & c.try_cast("timestamp").isNotNull(), "timestamp")
            .otherwise("text"))


def join_kinds(counts: dict[str, int], tolerance: float = 0.0) -> tuple[str, int]:
    """(type, cells that do not fit it) for a column's counts by kind."""
    cells = sum(n for kind, n in counts.items() if kind != "null")
    best = ("string", 0)
    if cells:
        fits = [(sum(counts.get(kind, 0) for kind, _ in chain), chain) for chain in CHAINS]
        n, chain = max(fits, key=lambda f: f[0])
        if cells - n <= tolerance * cells and n:
            best = ([name for kind, name in chain if counts.get(kind)][-1], cells - n)
    return best


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value of every line below ``path``."""
    raw = _raw_lines(spark, path)
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # one row per block of the listing that the driver holds already
    return raw.join(F.broadcast(blocks), ["file", "block"]).select(
        "file", (F.col("at") - F.col("first") + F.col("before") + 1).alias("line"), "value")


@dataclass(frozen=True)
class CsvScan:
    types: dict[str, str]
    counts: dict[str, dict[str, int]]
    rows: DataFrame
    rejects: DataFrame


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    tops = _raw_lines(spark, path).where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("value"))
    first = [r[0] for r in tops.select("value").distinct().limit(2).collect()]
    if len(first) > 1:
        raise ValueError(f"files with different headers: {first}")
    if not first:
        return []
    one = spark.createDataFrame([(first[0],)], "value string")
    width = one.select(F.size(F.split("value", "\\Q" + sep + "\\E", -1))).first()[0]  # not fewer than the names
    fields = ", ".join(f"c{i} string" for i in range(width))
    names = one.select(F.from_csv("value", fields, {"sep": sep}).alias("r"))
    return [name for name in names.select("r.*").first() if name is not None]


def scan_csv(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None,
             tolerance: float = 0.0, sep: str = ",", carry: tuple[str, ...] = ()) -> CsvScan:
    """Scan the files below ``path``; ``columns`` picks some, ``types`` states
    the types of some (the others are inferred from all their cells)."""
    header = _header(spark, path, sep)
    columns = header if columns is None else columns
    missing = [c for c in [*columns, *(types or {})] if c not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    parsed = _cells(spark, path, header, columns, sep)
    cell = {c: F.col(f"c{header.index(c)}") for c in columns}
    counts = _kind_counts(parsed, cell, [c for c in columns if c not in (types or {})])
    inferred = {c: join_kinds(counts[c], tolerance)[0] for c in counts}
    final = {c: (types or {}).get(c) or inferred[c] for c in columns}

    def misfit(c: str) -> Column:
        value, name = cell[c], final[c]
        if name == "double":  # Java also reads names and suffixes as numbers
            return value.isNotNull() & ~value.rlike(_NUMBER)
        return value.isNotNull() & value.try_cast(name).isNull()

    def reject(column: Column, text: Column, expected: str) -> Column:
        return F.struct(column.cast("string").alias("column_name"), text.alias("cell"), F.lit(expected).alias("expected"))

    bad = [F.when(misfit(c), reject(F.lit(c), cell[c], final[c])) for c in columns if final[c] != "string"]
    bad.append(F.when(F.col("broken").isNotNull(), reject(F.lit(None), F.col("broken"), f"{len(header)} cells")))
    rows = parsed.select(
        "file", "line", *[F.when(~misfit(c), cell[c].try_cast(final[c])).alias(c) if final[c] != "string"
                          else cell[c].alias(c) for c in columns],
        F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("rejected"))
    rejects = rows.where(F.size("rejected") > 0).select("file", "line", *carry, F.explode("rejected").alias("r")).select(
        "file", "line", *carry, "r.*")
    return CsvScan(final, counts, rows, rejects)


def _cells(spark: SparkSession, path: str, header: list[str], columns: list[str], sep: str) -> DataFrame:
    """file, line, the cells of ``columns`` (``c`` and their place in the
    header) and ``broken``: the text of a line with other cells than the
    header's, which is broken as a whole.  Written, for each later pass and
    each use of a cell would number and parse the lines again."""
    fields = ", ".join([*[f"c{i} string" for i in range(len(header))], "broken string"])
    lines = numbered_lines(spark, path).where((F.col("line") > 1) & (F.col("value") != ""))
    parsed = lines.select("file", "line", "value", F.from_csv(
        "value", fields, {"sep": sep, "columnNameOfCorruptRecord": "broken"}).alias("r"))
    whole = F.col("r.broken").isNull()
    places = sorted({header.index(c) for c in columns})
    return checkpointed(parsed.select("file", "line", *[F.when(whole, F.col(f"r.c{i}")).alias(f"c{i}") for i in places],
                                      F.when(~whole, F.col("value")).alias("broken")), "csv-cells")


def _kind_counts(parsed: DataFrame, cell: dict[str, Column], columns: list[str]) -> dict[str, dict[str, int]]:
    """Cells of each kind per column: partial counts, one row per (column,
    kind) at the end."""
    if not columns:
        return {}
    kinds = parsed.where(F.col("broken").isNull()).select(
        F.posexplode(F.array(*[cell_kind(cell[c]) for c in columns])).alias("at", "kind"))
    found = kinds.groupBy("at", "kind").count().collect()
    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    for r in found:
        out[columns[r["at"]]][r["kind"]] = r["count"]
    return out
