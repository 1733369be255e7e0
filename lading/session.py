"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Month folders and recency windows are calendar computations: pin the zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Checkpoints go when the frames that use them do.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "lading", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` takes further settings by their full name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Also makes sure ``DataFrame.checkpoint`` has a directory. A temporary folder
    is created only in local mode, where driver and executors are one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="lading-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one run's tables and files."""
    return f"{shared_folder(spark).rstrip('/')}/lading-{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str, shared_mount: bool = False) -> str:
    """``path`` as a full URI, as Spark's own file system settings resolve it.

    Executors then write where Spark reads. A folder on the machines' own disks is refused
    outside local mode, unless ``shared_mount`` says that all machines mount it.
    """
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
    full = filesystem.makeQualified(hadoop_path).toString()
    if full.startswith("file:") and not context.master.startswith("local") and not shared_mount:
        raise ValueError(f"{full} is on each executor's own disk; give a shared file system, or say it is a shared mount")
    return full


def moved_in(spark: SparkSession, staging: str, folder: str) -> None:
    """Rename the Parquet files of ``staging``, whose names are unique, into ``folder``."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    filesystem = path(staging).getFileSystem(context._jsc.hadoopConfiguration())
    for status in filesystem.listStatus(path(staging)):
        name = status.getPath().getName()
        if name.endswith(".parquet") and not filesystem.rename(status.getPath(), path(folder, name)):
            raise RuntimeError(f"{name} could not be moved from {staging} to {folder}")
    filesystem.delete(path(staging), True)


def exists(spark: SparkSession, folder: str) -> bool:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)


def sub_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders right below ``folder``; none if there is no such folder."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not filesystem.exists(path):
        return []
    return sorted(s.getPath().getName() for s in filesystem.listStatus(path) if s.isDirectory())


def removed(spark: SparkSession, *folders: str) -> None:
    """Delete folders of a job's own with all they hold."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
