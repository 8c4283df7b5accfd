"""Derived tables written once to the shared folder and read back.

A derived table that many branches of a plan read (the registry event log
built from the events table) is written as parquet under
``spark.checkpoint.dir`` the first time it is needed for a given input
snapshot, then scanned like any table.  This cuts the lineage (an executor
loss re-reads files instead of recomputing the derivation) and replaces N
recomputations by one write and N cheap scans.  The snapshot key is the
listing of the input files (paths, sizes, times), so changed inputs give a new table.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from arbiter.session import scratch_path

_LOCK = threading.Lock()
_TABLES: dict[tuple, str] = {}


def _listing(spark: SparkSession, path: str) -> str:
    """Digest of the files below ``path``: names, sizes and times.  A folder's
    own time would miss files added to a folder inside it, and object stores
    may have none."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr(sorted(seen)).encode()).hexdigest()


def materialized_path(spark: SparkSession, name: str, inputs: list[str],
                      write: Callable[[str], None]) -> str:
    """Like ``materialized`` for any file format: ``write(path)`` runs once
    per input snapshot; the folder is returned."""
    key = (spark.sparkContext.applicationId, "path:" + name,
           tuple((p, _listing(spark, p)) for p in inputs))
    with _LOCK:
        path = _TABLES.get(key)
        if path is None:
            path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
            write(path)
            _TABLES[key] = path
    return path


def materialized(spark: SparkSession, name: str, inputs: list[str],
                 build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
    key = (spark.sparkContext.applicationId, name,
           tuple((p, _listing(spark, p)) for p in inputs))
    with _LOCK:
        path = _TABLES.get(key)
        if path is None:
            path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
            w = build().write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _TABLES[key] = path
    return spark.read.parquet(path)


def checkpointed(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: several readers
    without recomputing, and a lost executor costs no earlier stage."""
    path = scratch_path(df.sparkSession, f"steps/{name}-{uuid.uuid4().hex[:12]}")
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
