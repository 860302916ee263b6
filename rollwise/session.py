"""Spark session settings and the shared scratch location.

Everything that must survive an executor loss (stream checkpoints, written
partial tables, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``. Only in local mode (tests, the bench), where there is one
machine, is a missing setting replaced by a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of this library relies on.
SQL_CONF = {
    # Dates are compared with an engine that has no session zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregation takes over the join's placing: a skewed item is split, and its rows are shuffled once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins by a shuffle hash the smaller side where each of its partitions, as measured, is small: no side is sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Backfills overwrite only the months they rebuild.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "rollwise", driver_memory: str | None = None) -> SparkSession:
    """A session for local runs (tests, bench, tools). In local mode the driver
    JVM is the only executor, so its heap (``driver_memory``) is the memory knob;
    it only applies when this call starts the JVM."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the SQL settings on an existing session (the driver hands us one)."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


#: Folders that a task of an unsorted write fills side by side; of more it sorts the rest of its rows.
OPEN_FILES = 16


@contextmanager
def unsorted_write(spark: SparkSession) -> Iterator[None]:
    """For writes by partition columns whose tasks have rows of few partitions each, in no order worth keeping: the rows are
    not sorted by these columns first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rollwise-ckpt-"))
        root = sc.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "rollwise", *parts, uuid.uuid4().hex])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rollwise`` importable in the Python workers, as ``--py-files`` does:
    the package is zipped once per application and added with ``addPyFile`` (Spark's
    own file distribution copies it from the driver). Needed where worker-side Python of
    this package runs; a cluster that already installs the package can skip it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="rollwise-py-"), "rollwise.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for d, _, names in os.walk(pkg):
            for f in names:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _shipped.add(sc.applicationId)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs a plain local path (tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "apply_conf", "checkpoint_root", "scratch_path", "local_path", "ship_package",
           "unsorted_write", "SQL_CONF"]
