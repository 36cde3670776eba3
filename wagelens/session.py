"""Session helpers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wagelens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder is seen by one machine and lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="wagelens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/wagelens/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let checkpoint() and iterative fits write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='wagelens-')}/wagelens", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
