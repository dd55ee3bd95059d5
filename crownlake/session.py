"""Session construction and shared-folder helpers.

Every job in this package is a function over DataFrames; the only session
state it relies on is set here: UTC session zone (timestamps in the data are
UTC), ANSI mode on, AQE on (runtime coalescing and skew-join splitting), and
dynamic partition overwrite so incremental writes replace only the partitions
they touch.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "crownlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Settings that may be changed on a live session are re-applied, so a
    # session created elsewhere (a driver, a notebook) gets the same semantics.
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.ansi.enabled",
        "spark.sql.adaptive.enabled",
        "spark.sql.sources.partitionOverwriteMode",
    ):
        spark.conf.set(key, conf[key])
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_settings(spark: SparkSession) -> None:
    """Pin the per-session settings the jobs depend on (zone, partition overwrite)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set, and the master is local (tests), a folder under the
    system temp dir is registered with ``SparkContext.setCheckpointDir`` (the config
    key itself cannot be changed on a running session).
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="crownlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for intermediate tables under the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/crownlake-work/{name}-{uuid.uuid4().hex[:12]}"
    for made in _open_scopes[-1:]:
        made.append(path)
    return path


# Folders that ``scratch_path`` gave inside each open ``lean_disk``, innermost last.
_open_scopes: list[list[str]] = []

LEAN_DISK = {
    # A query's shuffle files go when it ends, not whenever the driver collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Up to so many partition folders are written side by side, without sorting (and spilling) a task's rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Ids are hex digits, of which snappy saves nothing.
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """A job of many writes that holds only what later steps read: see ``LEAN_DISK``; what the session already sets, stays.

    On leaving, the folders that ``scratch_path`` gave inside are removed: nothing
    that reads them may be returned.
    """
    from crownlake.sources.sinks import remove_folder

    added = {key: value for key, value in LEAN_DISK.items() if spark.conf.get(key, None) is None}
    for key, value in added.items():
        spark.conf.set(key, value)
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            remove_folder(spark, path)
        for key in added:
            spark.conf.unset(key)


# Target sizes for one task's share of a shuffle or of a file scan.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
SCAN_SPLIT_BYTES = 256 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200


def size_for_input(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Size shuffles and scans from the input size and apply it to the session.

    Shuffle partitions start at about one per 128 MB of input (at least 200), so the
    largest stage fits executor memory without relying on spill; AQE then
    coalesces small partitions toward the advisory size and splits skewed ones.
    At 100 TB this gives ~800k initial partitions; scans read 256 MB splits.
    """
    partitions = -(-int(input_bytes) // SHUFFLE_PARTITION_BYTES)
    partitions = max(MIN_SHUFFLE_PARTITIONS, partitions)
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * SCAN_SPLIT_BYTES),
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (any Hadoop filesystem)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
