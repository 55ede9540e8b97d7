"""Session construction and shared-folder helpers.

Everything that has to outlive one Spark job (scratch trees, staged tables,
stream checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is made only when that setting
is unset, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this engine wants: AQE re-plans joins and
# coalesces small shuffles at runtime, UTC keeps date rendering stable, and
# the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "bibflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are meant for local runs; on a
    cluster leave them to the deployment.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and scratch tables.

    Read from the session; only when nothing is configured (local tests) a
    private temporary folder is created and registered as checkpoint dir.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = sc.getCheckpointDir()
        except Exception:  # pragma: no cover - older API
            base = None
    if not base:
        base = tempfile.mkdtemp(prefix="bibflow-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = f"{base}/bibflow-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freed_shuffles(spark: SparkSession):
    """Jobs begun inside the block remove their shuffle files when they end.  By itself Spark keeps them until the
    driver's JVM happens to collect their plans, beside what later jobs write."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``bibflow`` importable in Python workers (for ``mapInPandas``).

    The package is zipped once per SparkContext into the shared folder and
    added with ``addPyFile``, which distributes it to every executor.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles")
    if "://" in target:
        # A remote shared folder cannot be written by ``make_archive``; the
        # archive is built next to the driver and ``addPyFile`` ships it.
        target = tempfile.mkdtemp(prefix="bibflow-zip-")
    os.makedirs(target, exist_ok=True)
    archive = shutil.make_archive(os.path.join(target, "bibflow"), "zip",
                                  os.path.dirname(pkg_dir), "bibflow")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
