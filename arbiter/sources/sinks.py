"""Sinks: run logs, JSON artifacts, audit trail, JSON tables.

All sinks write under a folder of the shared checkpoint/warehouse location
(``spark.checkpoint.dir`` on a cluster) and never overwrite history: run
logs, audit records and artifacts are appends made visible by commit
(``sources/commits``), idempotent by commit key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter import schemas as S
from arbiter.session import scratch_path
from arbiter.sources import commits
from arbiter.sources.commits import commit_write, read_committed


def fresh_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# --- audit trail ---------------------------------------------------------------------

def append_audit(rows: DataFrame, path: str, key: str | None = None) -> bool:
    """Append-only: each deployment adds files; nothing is rewritten.  A
    deployment whose ``key`` is committed is not appended again."""
    return commit_write(rows.select(*[F.col(f.name).cast("string") for f in S.AUDIT.fields]), path, key)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, S.AUDIT)


# --- run log (params / metrics / tags as one long table) ----------------------------

RUN_LOG = "run_id string, key string, text string, number double, kind string, run_date string"


def numeric_metrics(long: DataFrame, value: str = "value") -> DataFrame:
    """Metric logging keeps numeric values only (non-numeric text dropped)."""
    v = F.expr(f"try_cast({value} AS DOUBLE)")
    return long.withColumn(value, v).where(F.col(value).isNotNull())


def run_entries(wide: DataFrame, run_id: str, params, metrics, tags) -> DataFrame:
    """One row per (run_id, kind, key) from wide run rows, in one pass.
    ``params``, ``metrics`` and ``tags`` are column names or (column, logged
    key) pairs.  Metrics that are not numeric are dropped, as metric logging
    does; a NULL parameter or tag is kept."""
    pairs = [(kind, *(k if isinstance(k, tuple) else (k, k)))
             for kind, keys in (("param", params), ("metric", metrics), ("tag", tags)) for k in keys]
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"),
                                 F.col(f"`{c}`").cast("string").alias("text")) for kind, c, key in pairs])
    long = wide.select(F.col(run_id).cast("string").alias("run_id"), F.explode(entries).alias("e")).select(
        "run_id", "e.key", "e.text", F.when(F.col("e.kind") == "metric", F.expr("try_cast(e.text AS DOUBLE)"))
        .alias("number"), "e.kind")
    return long.where((F.col("kind") != "metric") | F.col("number").isNotNull())


def log_runs(wide: DataFrame, root: str, run_date: str, run_id: str, params: list, metrics: list, tags: list,
             key: str | None = None) -> bool:
    """Persist one row per run as a long table under ``root``: params and
    tags as text, metrics as numbers, all visible by one commit.  A job whose
    ``key`` is committed logs nothing again."""
    rows = run_entries(wide, run_id, params, metrics, tags).withColumn("run_date", F.lit(run_date))
    return commit_write(rows, root, key, partition_by=["kind", "run_date"])


def read_run_log(spark: SparkSession, root: str, kind: str | None = None) -> DataFrame:
    """run_id, key, text, number, kind, run_date of all committed runs;
    ``kind`` (param, metric, tag) prunes to its folders."""
    rows = read_committed(spark, root, RUN_LOG)
    return rows.where(F.col("kind") == kind) if kind else rows


# --- artifacts ------------------------------------------------------------------------------

def write_artifacts(records: DataFrame, path: str, run_col: str, key: str | None = None) -> bool:
    """Per-case records of each run as JSON lines under ``<run_col>=<run>/``.

    The per-run document is a folder of files, not one collected array: a run
    with millions of cases is written by many tasks and never held in one
    row.  A write is one generation; its manifest counts the records of every
    run and its commit makes it visible as a whole."""
    return commit_write(records.withColumn(run_col, F.col(run_col).cast("string")), path, key, [run_col], "json",
                        manifest=[run_col])


def read_artifacts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of all committed generations."""
    return read_committed(spark, path, schema, "json")


def read_newest_generation(spark: SparkSession, path: str, schema: str, run_col: str) -> DataFrame:
    """All records of the newest committed generation of every run."""
    return commits.read_newest(spark, path, schema, run_col, "json")


def newest_files(spark: SparkSession, path: str) -> list[str]:
    """The newest data file of every folder below ``path`` by modification
    time (ties: by name), from the listing: nothing is opened."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    newest: dict[str, tuple[int, str]] = {}
    while files.hasNext():
        f = files.next()
        name = f.getPath().getName()
        if not name.startswith(("_", ".")):
            folder = f.getPath().getParent().toString()
            newest[folder] = max(newest.get(folder, (-1, "")), (f.getModificationTime(), f.getPath().toString()))
    return sorted(p for _, p in newest.values())


def read_newest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of the newest file of every run folder of a plain directory,
    where one file is one artifact and nothing was committed (as in folders
    filled by hand); :func:`read_newest_generation` reads what this module wrote."""
    files = newest_files(spark, path)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).json(files)


def write_json_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
