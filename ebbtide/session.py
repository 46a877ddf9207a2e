"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_root: str | None = None
#: Setting by which Spark removes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "ebbtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. On a cluster the master, the memory
    sizes and ``spark.checkpoint.dir`` come from spark-submit; ``master`` is for
    local runs only."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder for one written intermediate.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``, which
    every executor can reach. Only where that is unset (local tests) does a
    machine-local folder stand in.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="ebbtide-")
        root = _local_root
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """What an execution in here has shuffled is removed at its end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
