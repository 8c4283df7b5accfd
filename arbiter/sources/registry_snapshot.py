"""Registry state kept on the shared folder: a snapshot, and the events since.

The state's tables are written per snapshot and made visible by a commit that
names the last event they cover.  A refresh folds only the events after it
(a range of the log that the scan's statistics prune to) into the newest
snapshot; readers scan the small state tables and never the log.  The log is
append-only in ``seq``: an event with a number that a snapshot covers already
is not seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.operators.registry import RegistryState, fold_log
from arbiter.sources import commits as C

TABLES = {"versions": "model string, version string, reg_seq bigint, run_id string, del_seq bigint",
          "aliases": "model string, alias string, version string, set_seq bigint",
          "tags": "model string, version string, tag_key string, tag_value string, set_seq bigint"}


def _read(spark: SparkSession, root: str, gen: str) -> RegistryState:
    return RegistryState(**{t: spark.read.schema(schema).parquet(f"{root}/state/{gen}/{t}") for t, schema in TABLES.items()})


def newest(spark: SparkSession, root: str) -> tuple[RegistryState, int] | None:
    """(state, last event it covers) of the newest snapshot."""
    last = C.commits(spark, root).orderBy(F.desc("number"), F.desc("gen")).first()
    return (_read(spark, root, last["gen"]), int(last["key"].removeprefix("upto-"))) if last else None


def refresh(spark: SparkSession, root: str, events: DataFrame) -> RegistryState:
    """The state after all ``events``; what a snapshot covers is not read
    again.  Two refreshes up to one event commit one snapshot."""
    root, found = root.rstrip("/"), newest(spark, root)
    state, upto = found or (None, None)
    delta = events if upto is None else events.where(F.col("seq") > upto)
    last = delta.agg(F.max("seq")).first()[0]
    if last is None:
        return state or fold_log(events)
    gen = uuid.uuid4().hex

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/state/{gen}/{name}"
        df.select(*[c.split()[0] for c in TABLES[name].split(", ")]).write.parquet(path)
        return spark.read.schema(TABLES[name]).parquet(path)

    fold_log(delta, state, keep)
    C.publish(spark, root, gen, f"upto-{last}")
    return newest(spark, root)[0]
