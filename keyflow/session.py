"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_run: ContextVar[str] = ContextVar("keyflow_run", default="")


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; casts from zone-less columns follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) falls back to a temporary folder; on a cluster
    a machine-local folder would be lost with its machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="keyflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, used for tables that cut lineage."""
    folder = f"{shared_folder(spark)}/keyflow"
    return f"{folder}/{_run.get()}{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside lie in one folder, which goes at the end: for runs that write all their results."""
    run = f"run-{uuid.uuid4().hex}/"
    before = _run.set(run)
    try:
        yield
    finally:
        _run.reset(before)
        remove_folder(spark, f"{shared_folder(spark)}/keyflow/{run}")
