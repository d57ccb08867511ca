"""Session creation and the shared scratch area."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def get_spark(
    app_name: str = "odoscore",
    master: str | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one.

    ``input_bytes`` sizes the initial shuffle partition count (about 128 MB
    each); AQE then coalesces downwards, so a generous start is safe.  Without
    it the cluster's own setting is kept.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites in error messages cost several milliseconds per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for name, value in (extra or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions(input_bytes: int, minimum: int = 8) -> int:
    """Initial shuffle partitions for a job that reads ``input_bytes``."""
    return max(minimum, math.ceil(input_bytes / TARGET_PARTITION_BYTES))


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a folder of its own; on a cluster a missing setting is an
    error, because a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    # A folder set on the context directly counts as well.
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="odoscore-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The store that holds ``path``, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the store that holds ``path``; one that is gone already is no error."""
    files, place = file_system(spark, path)
    files.delete(place, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file within one store, in place of a file of the target's name."""
    files, place = file_system(spark, source)
    _, goal = file_system(spark, target)
    files.mkdirs(goal.getParent())
    if files.exists(goal):
        files.delete(goal, False)
    if not files.rename(place, goal):
        raise OSError(f"cannot move {source} to {target}")
