"""Session helpers.

Library code never creates a session: it receives DataFrames. These helpers
exist for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every homestead job relies on. ANSI mode stays on (Spark 4
# default); operators use try_* functions where a bad value must become NULL.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Fall back from whole-stage codegen when a fused stage's generated method
    # is larger than the JVM JIT will compile (8000 bytecodes); such a method
    # would otherwise run interpreted, ~2x slower on the wide listing stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "homestead",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with homestead's base settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Work tables that cut lineage are written below it, so they live on the
    cluster's shared storage and survive the loss of any executor.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir. An unset one is set to a fresh
    local folder only under a local master (tests, the bench), where driver
    and executors are one process; on a cluster it must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="homestead-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _work_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/homestead-work/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a work table under the shared checkpoint folder."""
    return f"{_work_root(spark)}/{name}-{os.urandom(6).hex()}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete this application's work tables, once nothing reads them any
    more (DataFrames returned by operators may). Checkpoints go with Spark's
    own cleaner where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_work_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs and streams started within."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``homestead`` importable in executor Python workers.

    Clusters normally install it (wheel or ``--py-files``); this fallback
    zips the package on the driver once per application and registers it
    with ``addPyFile``, which Spark distributes to every executor.
    """
    import zipfile
    try:
        sc = spark.sparkContext
    except Exception:  # Connect sessions ship artifacts differently
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="homestead-pyfiles-")
    zpath = os.path.join(out_dir, "homestead.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
