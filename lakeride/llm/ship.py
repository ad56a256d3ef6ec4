"""Sends this package to the executors, so that tasks can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()
#: bytes of an Arrow batch between executor and Python worker, unless the session sets its own
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def to_executors(spark: SparkSession) -> None:
    """Once per application: the package's sources as one zip, as ``--py-files`` would do."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))  # texts: a batch is bounded by bytes, small enough for both sides
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lakeride-py-"), "lakeride_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SENT.add(context.applicationId)
