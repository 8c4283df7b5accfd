"""arbiter — evaluation and model-lifecycle analytics as Spark jobs.

Responses, cases, judge output, telemetry and registry events are
DataFrames; every operator is a ``DataFrame -> DataFrame`` function that
Catalyst can plan end to end.  See README.md for the module map.
"""

__all__ = ["session", "schemas", "defaults"]
