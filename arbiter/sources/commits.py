"""Folders whose contents become visible by commit.

Layout below a root:

* ``data/commit_gen=<id>/...``: the files of one write, made by many tasks;
* ``manifests/commit_gen=<id>/...``: rows per group of that write, counted from the
  files themselves;
* ``commits/<digest of the key>.json``: one small file per finished write,
  made last and only if absent.

Readers start from the commits, so the files of a job that died are never
seen, and a write whose key is committed already is not done again: a rerun
leaves one set of rows.  Generations are ordered by their commit number, ties
by their id.  Only commits and manifests are read to choose; the data scan is
pruned to the generations that were chosen.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEN = "commit_gen"   # the folders' partition column; not a name that data would have
COMMIT = "gen string, key string, number bigint, committed_at bigint"


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _filesystem(spark, path)
    return fs.exists(p)


def _marker(root: str, key: str) -> str:
    return f"{root.rstrip('/')}/commits/{hashlib.sha256(key.encode()).hexdigest()[:40]}.json"


def is_committed(spark: SparkSession, root: str, key: str) -> bool:
    return exists(spark, _marker(root, key))


def stage(df: DataFrame, root: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
          manifest: Sequence[str] = ()) -> str:
    """Write ``df`` as a generation that nobody reads yet; returns its id."""
    gen, root = uuid.uuid4().hex, root.rstrip("/")
    path = f"{root}/data/{GEN}={gen}"
    writer = df.write.format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    if manifest:
        back = df.sparkSession.read.schema(df.schema).format(fmt).load(path)
        back.groupBy(*manifest).agg(F.count(F.lit(1)).alias("n_rows")).write.parquet(f"{root}/manifests/{GEN}={gen}")
    return gen


def publish(spark: SparkSession, root: str, gen: str, key: str | None = None) -> bool:
    """Make a staged generation visible; False if ``key`` is committed."""
    key = key or gen
    numbers = commits(spark, root).agg(F.max("number")).first()[0]
    record = json.dumps({"gen": gen, "key": key, "number": (numbers or 0) + 1, "committed_at": int(time.time() * 1000)})
    p, fs = _filesystem(spark, _marker(root, key))
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)  # fails where another writer has committed the key
    except Exception as e:  # noqa: BLE001 - py4j wraps the Java error
        if "FileAlreadyExists" in str(e):
            return False
        raise
    try:
        out.write(bytearray(record.encode()))
    finally:
        out.close()
    return True


def commit_write(df: DataFrame, root: str, key: str | None = None, partition_by: Sequence[str] = (),
                 fmt: str = "parquet", manifest: Sequence[str] = ()) -> bool:
    """Stage and publish ``df``; nothing is written, and False returned, where
    ``key`` is committed already."""
    spark = df.sparkSession
    if key and is_committed(spark, root, key):
        return False
    return publish(spark, root, stage(df, root, partition_by, fmt, manifest), key)


def commits(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/commits"
    if not exists(spark, path):
        return spark.createDataFrame([], COMMIT)
    # a marker that is being written has no record yet
    return spark.read.schema(COMMIT).option("mode", "DROPMALFORMED").json(path).where("gen is not null")


def _data(spark: SparkSession, root: str, schema: str | T.StructType, fmt: str) -> DataFrame:
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    full = T.StructType([*fields.fields, T.StructField(GEN, T.StringType())])
    return spark.read.schema(full).format(fmt).load(f"{root.rstrip('/')}/data")


def read_committed(spark: SparkSession, root: str, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame:
    """Rows of all committed generations."""
    if not exists(spark, f"{root.rstrip('/')}/commits"):
        return spark.createDataFrame([], schema)
    return _data(spark, root, schema, fmt).join(
        commits(spark, root).select(F.col("gen").alias(GEN)), GEN, "left_semi").drop(GEN)


def newest(spark: SparkSession, root: str, group: str) -> DataFrame:
    """(group, commit_gen, n_rows): the newest committed generation of each group."""
    root = root.rstrip("/")
    manifests = spark.read.option("basePath", f"{root}/manifests").schema(
        f"`{group}` string, n_rows bigint, {GEN} string").parquet(f"{root}/manifests")
    known = manifests.join(commits(spark, root).select(F.col("gen").alias(GEN), "number"), GEN)
    return known.groupBy(group).agg(F.max_by(F.struct(GEN, "n_rows"), F.struct("number", GEN)).alias("best")).select(
        group, f"best.{GEN}", "best.n_rows")


def read_newest(spark: SparkSession, root: str, schema: str | T.StructType, group: str, fmt: str = "parquet") -> DataFrame:
    """All rows of each group's newest committed generation (``group`` is a
    string column of ``schema``)."""
    if not exists(spark, f"{root.rstrip('/')}/commits"):
        return spark.createDataFrame([], schema)
    chosen = newest(spark, root, group).select(GEN, group)
    return _data(spark, root, schema, fmt).join(chosen, [GEN, group], "left_semi").drop(GEN)


def incomplete(spark: SparkSession, root: str, schema: str | T.StructType, group: str, fmt: str = "parquet") -> DataFrame:
    """(group, commit_gen, n_rows, n_found) of newest generations whose files no
    longer hold the rows that their manifest counted."""
    found = _data(spark, root, schema, fmt).groupBy(GEN, group).agg(F.count(F.lit(1)).alias("n_found"))
    return (newest(spark, root, group).join(found, [GEN, group], "left")
            .select(group, GEN, "n_rows", F.coalesce("n_found", F.lit(0)).alias("n_found")).where("n_rows <> n_found"))
