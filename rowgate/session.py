"""Where a job may put intermediate tables.

Shared storage only: the folder the cluster names in ``spark.checkpoint.dir``
(or the SparkContext checkpoint directory).  A machine-local temporary folder
is used only when neither is set *and* the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for intermediate tables")
        base = tempfile.mkdtemp(prefix="rowgate-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared directory."""
    return f"{shared_dir(spark)}/rowgate/{label}-{uuid.uuid4().hex[:12]}"
