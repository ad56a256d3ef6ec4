"""Session helpers.

Every operator works on ``TIMESTAMP_NTZ`` wall-clock values (the source
stamps carry a literal ``Z`` that the ingest discards). The few places that
convert between NTZ and epoch micros (metric step grids) rely on the session
time zone being UTC, so :func:`pin_session` sets it; ANSI mode stays on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_DIRNAME = "lakeride-scratch"


def build_session(app: str = "lakeride", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session builder. On a cluster the submitter owns the session."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    # only effective when this call launches the JVM (local mode / tests)
    builder = builder.config("spark.driver.memory", os.environ.get("LAKERIDE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Settings the operators' semantics depend on (idempotent, cheap)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session, else from the context's checkpoint folder. Only a
    single-machine session (``local`` / ``local[n]``) that names neither gets
    a temporary folder, which is recorded on the context so later calls
    agree. Executors on other machines could not read such a folder, so any
    other master without a configured folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set and the master is {master!r}: "
                "name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakeride-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{SCRATCH_DIRNAME}/{name}-{uuid.uuid4().hex[:12]}"


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme for os-level helpers used by tests."""
    return path[5:] if path.startswith("file:") else path


def materialize(df, name: str, options: dict | None = None):
    """Cut lineage by writing ``df`` once as Parquet under the shared
    checkpoint folder and reading it back. ``options``: of the writer.

    Unlike an unpersisted ``checkpoint()``, which computes its input once
    for the action and again to write the files, this computes it once; the
    result survives lost executors and is read back with column pruning and
    normal file splits."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)
