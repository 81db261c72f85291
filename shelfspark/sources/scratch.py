"""Where intermediate tables go: a folder that the driver and all executors share, named by a setting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import SparkSession

CLUSTER_KEY = "spark.checkpoint.dir"
SESSION_KEY = "spark.shelfspark.scratch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or else below ``spark.shelfspark.scratch``; one must be set."""
    base = spark.conf.get(CLUSTER_KEY, None) or spark.conf.get(SESSION_KEY, None)
    if not base:
        raise ValueError(f"set {CLUSTER_KEY} (or, for this session, {SESSION_KEY}) to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def set_local_scratch(spark: SparkSession) -> None:
    """For trial runs in one JVM: name a temporary folder where the session names none. A cluster must name its own."""
    if spark.conf.get(CLUSTER_KEY, None) or spark.conf.get(SESSION_KEY, None):
        return
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CLUSTER_KEY} to a folder all executors share")
    spark.conf.set(SESSION_KEY, tempfile.mkdtemp(prefix="shelf-"))


def drops_shuffles(job: Callable) -> Callable:
    """A job, given the session first, whose actions leave no shuffle files behind. Otherwise those stay on the executors'
    disks until the driver happens to collect its garbage, beside everything the job moves afterwards."""

    @wraps(job)
    def run(spark: SparkSession, *args: Any, **kwargs: Any) -> Any:
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            return job(spark, *args, **kwargs)
        finally:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)

    return run


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove what a job has stored below its scratch path, on whatever file system that is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
