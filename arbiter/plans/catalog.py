"""Registry of named queries: a Spark builder and, where SQL can state the
same result, an oracle query over the driver tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class QuerySpec:
    name: str
    build: Builder
    sql: str | None


_REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, sql: str | None = None):
    """Decorator registering ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = QuerySpec(name, fn, sql)
        return fn
    return deco


def registry() -> dict[str, QuerySpec]:
    _load_all()
    return dict(_REGISTRY)


def _load_all() -> None:
    # importing the plan modules registers their queries
    from arbiter.plans import (experiment, judge_plans, lifecycle, conversations_plans,  # noqa: F401
                               io_plans, scorer_plans, ml_plans, telemetry_plans,
                               streaming_plans, scoring_plans, registration_plans)


def finalize(df: DataFrame, decimals: int = 6, exact: bool = False) -> DataFrame:
    """Output boundary: half-even rounding of every double column so results
    compare by value across engines (``exact``: on the binary value, for
    magnitudes where the decimal representation is too short)."""
    from arbiter.functions.rounding import exact_round
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name).cast("double")
            r = exact_round(c, decimals) if exact else F.bround(c, decimals) + F.lit(0.0)
            cols.append(r.alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
