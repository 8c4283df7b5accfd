"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.session import apply_runtime_conf, override_conf, scratch_path

# Words of the text contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings of these jobs, until the next query's: Arrow batches
    small enough for a Python worker, and shuffle files dropped once their
    query has ended (an operator that writes several tables holds one shuffle
    at a time)."""
    apply_runtime_conf(spark)
    override_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
                          "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
                          "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def lean(work):
    """A function for ``mapInArrow`` that hands its memory back at the end: an
    idle Python worker otherwise keeps what its last task needed."""
    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            release_memory()
    return run


def release_memory() -> None:
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, row_group_mb: int = 16) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and later readers do not recompute."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    (df.write.option("parquet.block.size", row_group_mb << 20)
       .option("compression", "zstd").parquet(path))
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    path = getattr(df, "_llm_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = df.sparkSession._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Number of groups so that each holds about ``per_part`` rows."""
    return max(least, math.ceil(rows / per_part))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would fold other scripts as well)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
