"""Spark session settings the engine relies on, and a shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes: UTC clock, AQE on (coalescing + skew-join split),
# Arrow for the few Python boundaries, no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Stateful streaming operators (history state) need RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "arbiter", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass master=None and let
    spark-submit decide; shuffle partitions then stay AQE-managed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("ARBITER_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``arbiter`` importable in Python workers (pandas UDFs,
    mapInPandas, stateful processors) on every executor: the package is
    zipped once on the driver and distributed with ``addPyFile``."""
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship with addArtifacts instead
        return
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="arbiter-pyfiles-"), "arbiter.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


_OVERRIDDEN: dict[str, str | None] = {}


def override_conf(spark: SparkSession, values: dict[str, str]) -> None:
    """Settings for the jobs that follow, until :func:`apply_runtime_conf`
    puts back what was there before."""
    for key, value in values.items():
        _OVERRIDDEN.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime SQL settings that are safe to set on an existing session;
    those that another job overrode are put back."""
    ship_package(spark)
    while _OVERRIDDEN:
        key, value = _OVERRIDDEN.popitem()
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # pragma: no cover - immutable on some deployments
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the setting is absent (local tests) do we create one under the
    system temp folder and record it in the session so later calls agree.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="arbiter-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # pragma: no cover - static conf on some builds
        pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
