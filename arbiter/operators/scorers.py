"""Pluggable per-row scorers and the report that aggregates them.

A scorer is ``name -> Callable[[], Column]`` (built-in expressions, JVM-side)
or a vectorised Python function registered with ``python_scorer`` (pandas
UDF, Arrow batches).  The report evaluates every scorer in one projection,
unpivots to (scorer, value) and aggregates per scorer: one pass, one
shuffle keyed by scorer name with map-side partial aggregation.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter import defaults as D
from arbiter.functions.json_fns import is_json, min_items
from arbiter.functions.text import col


def exact_match(output, expected) -> Column:
    """1 when the output equals the expected response, else 0."""
    return (col(output).eqNullSafe(col(expected))).cast("int")


def python_scorer(fn: Callable[[pd.Series], pd.Series], return_type=T.DoubleType()):
    """Wrap a vectorised Python scorer as a pandas UDF."""
    return F.pandas_udf(fn, return_type)


class ScorerRegistry:
    def __init__(self):
        self._scorers: dict[str, Callable[[], Column]] = {}

    def register(self, name: str, builder: Callable[[], Column]) -> "ScorerRegistry":
        if name in self._scorers:
            raise ValueError(f"scorer {name} already registered")
        self._scorers[name] = builder
        return self

    def scorer(self, name: str):
        """Decorator form: ``@registry.scorer("is_json")``."""
        def deco(builder):
            self.register(name, builder)
            return builder
        return deco

    def names(self) -> list[str]:
        return list(self._scorers)

    def columns(self) -> list[Column]:
        return [b().cast("double").alias(n) for n, b in self._scorers.items()]


def apply_scorers(df: DataFrame, registry: ScorerRegistry, keys: list[str]) -> DataFrame:
    """Long per-row results (keys..., scorer, value)."""
    wide = df.select(*keys, *registry.columns())
    return wide.unpivot(keys, registry.names(), "scorer", "value")


def scorer_report(df: DataFrame, registry: ScorerRegistry, keys: list[str]) -> DataFrame:
    """Mean and count of every scorer over all rows."""
    long = apply_scorers(df, registry, keys)
    return long.groupBy("scorer").agg(F.count("value").alias("n"),
                                      F.avg("value").alias("mean"))


def default_registry(output: str = "output", expected: str = "expected") -> ScorerRegistry:
    reg = ScorerRegistry()
    reg.register("exact_match", lambda: exact_match(output, expected))
    reg.register("is_json", lambda: is_json(output))
    reg.register("minimum_five_skills", lambda: min_items(output, "skills", D.MIN_SKILLS))
    return reg
