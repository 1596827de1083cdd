"""Session helpers: a tuned local session for tests, and the shared work folder.

Everything this library writes between steps (staged rows, landed test files,
stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. It is read from the session; only a session whose
tasks run in the driver's own process gets a temporary folder (tests, the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8, app: str = "tidesync") -> SparkSession:
    """Session with the settings this library assumes.

    ANSI mode stays on (bad casts fail loudly), the session clock is UTC so
    TIMESTAMP_NTZ values agree with any SQL oracle, and AQE re-plans joins from
    runtime sizes (broadcast only what it measured as small, split skewed
    partitions, coalesce small shuffle partitions).

    ``master=None`` leaves the master (and the shuffle width, with
    ``shuffle_partitions=None``) to the launcher, e.g. ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", os.environ.get("TIDESYNC_DRIVER_MEMORY", "8g"))
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Shuffled joins with a filtered side drop rows of the other side in its scan, from this size on.
        .config("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1GB")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate data, from ``spark.checkpoint.dir``.

    A cluster session must name it, because a machine-local folder is not
    visible to other executors (a running session can't be given one later).
    Only a plain local session, whose tasks run in the driver, gets a
    temporary folder, kept for as long as the session object.
    """
    d = spark.conf.get(CHECKPOINT_KEY, None) or getattr(spark, "_tidesync_work_dir", None)
    if not d:
        if not _is_local(spark.conf.get("spark.master", "")):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        d = spark._tidesync_work_dir = tempfile.mkdtemp(prefix="tidesync-")
    return d.rstrip("/")


def _is_local(master: str) -> bool:
    """Whether all tasks run in the driver's own process (``local-cluster`` does not)."""
    return master == "local" or master.startswith("local[")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used folder under the work folder."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster's file system (any scheme).

    Asks the file system the session is configured for, so no failing read is
    needed. Errors while looking (permissions, network) are raised: they are
    not a missing path.
    """
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Immediate sub-folders of ``path`` on the cluster's file system."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [st.getPath().toString() for st in fs.listStatus(jpath) if st.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on the cluster's file system."""
    fs, jpath = _fs(spark, path)
    return bool(fs.delete(jpath, True))
