"""Versioned MLlib models on the shared folder with an append-only registry
event log; aliases are resolved through ``registry.alias_state``.

Several models share a root and its log.  An event's number is the log's next
one, taken by the commit that makes the event visible, so stores that were
opened later, or write at the same time, continue one sequence.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arbiter import schemas as S
from arbiter.operators import registry as R
from arbiter.session import scratch_path
from arbiter.sources import commits as C
from arbiter.sources.materialize import checkpointed


class ModelStore:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> "ModelStore":
        return cls(spark, scratch_path(spark, f"models/{name}-{uuid.uuid4().hex[:8]}"), name)

    def sibling(self, name: str) -> "ModelStore":
        """The store of another model under the same root."""
        return ModelStore(self.spark, self.root, name)

    def events(self) -> DataFrame:
        """The log of all models under the root."""
        return C.read_committed(self.spark, f"{self.root}/events", S.REGISTRY_EVENT)

    def _append(self, kind: str, version=None, alias=None, key=None, value=None, run_id=None):
        last = self.events().agg(F.max("seq")).first()[0] or 0
        while True:
            last += 1
            row = [(self.name, last, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), kind,
                    version, alias, key, value, run_id)]
            # one writer gets the number, the others try the next
            if C.commit_write(self.spark.createDataFrame(row, S.REGISTRY_EVENT), f"{self.root}/events", f"seq-{last}"):
                return

    def _path(self, name: str, version: str) -> str:
        return f"{self.root}/versions/{name}/{version}"

    def register(self, model: PipelineModel) -> str:
        latest = R.highest_version(self.events()).where(F.col("model") == self.name).first()
        version = str((latest["highest_version"] if latest else 0) + 1)
        model.write().overwrite().save(self._path(self.name, version))
        self._append("register", version=version)
        return version

    def set_alias(self, alias: str, version: str) -> None:
        self._append("set_alias", version=version, alias=alias)

    def delete_version(self, version: str) -> None:
        self._append("delete_version", version=version)

    def resolve(self, alias: str | None = None, version: str | None = None) -> str:
        """Explicit version, else the alias's current holder."""
        if version:
            return version
        row = (R.alias_state(self.events())
               .where((F.col("model") == self.name) & (F.col("alias") == alias)).first())
        if row is None:
            raise LookupError(f"alias {alias!r} is not set for {self.name}")
        return row["version"]

    def load(self, version: str) -> PipelineModel:
        return PipelineModel.load(self._path(self.name, version))

    def predict_by_alias(self, rows: DataFrame, model_col: str, alias: str) -> DataFrame:
        """``rows`` with ``version`` and ``prediction``: each row is scored by
        the model that its ``model_col`` names, in the version that holds
        ``alias`` in the log.  A row whose model has no such version keeps
        NULLs.

        Rows are written once, partitioned by model, so each model reads its
        own rows only; the number of branches is that of the models that hold
        the alias."""
        holders = {r["model"]: r["version"] for r in R.alias_state(self.events())
                   .where(F.col("alias") == alias).select("model", "version").collect()}
        grouped = checkpointed(rows.withColumn("_model", F.col(model_col)), "inference-rows", partition_by=["_model"])
        known = sorted(holders)
        out = grouped.where(~F.coalesce(F.col("_model").isin(known), F.lit(False))).select(
            *rows.columns, F.lit(None).cast(T.StringType()).alias("version"), F.lit(None).cast("double").alias("prediction"))
        for name in known:
            model = PipelineModel.load(self._path(name, holders[name]))
            scored = model.transform(grouped.where(F.col("_model") == name))
            out = out.unionByName(scored.select(*rows.columns, F.lit(holders[name]).alias("version"), "prediction"))
        return out
