"""Readers for the driver's parquet tables.

Every reader takes the column list it needs so the scan's ReadSchema is pruned
and filters placed on the result are pushed into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df


def read_events(spark: SparkSession, sf_dir: str,
                columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """events with ``ts`` as a session-zone TIMESTAMP (parquet stores it NTZ;
    watermarks and windows need the zoned type)."""
    df = read_table(spark, sf_dir, "events", columns)
    if "ts" in df.columns:
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    return df


def typed_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """CSV with a header, read as text and cast column by column, so no type
    is guessed from a sample.  ``rejected`` names the columns whose text does
    not fit their type (they are NULL); callers keep, count or drop such rows."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    raw = header.select(*[F.col(c) for c in columns])
    bad = F.filter(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in columns.items()]),
        lambda c: c.isNotNull())
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()], bad.alias("rejected"))
