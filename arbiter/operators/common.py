"""Shared helpers: checked broadcast, rounding at the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _driver_local(df: DataFrame) -> bool:
    """True when every leaf of the plan is data created on the driver."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        names = [leaves.apply(i).nodeName() for i in range(leaves.size())]
    except Exception:  # noqa: BLE001
        return False
    return bool(names) and all(n in ("LocalRelation", "LogicalRDD", "OneRowRelation", "Range")
                               for n in names)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for config built on the driver (cases, templates,
    probes, gates, tools): its size is bounded by what the driver already
    holds.  Everything read or computed gets no hint: it stays a shuffled
    join input, at every scale, and AQE converts it only from measured sizes."""
    return F.broadcast(df) if _driver_local(df) else df
