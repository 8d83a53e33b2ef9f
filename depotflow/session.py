"""Session helpers: defaults for stand-alone runs and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITION_BYTES = 200 * 1024**2

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"

_local_fallbacks: dict[str, str] = {}


def shuffle_partitions(shuffled_bytes: int, at_least: int = 200) -> int:
    """Partitions that keep a shuffle of this size near 200 MiB each.

    The adaptive planner merges small partitions at run time but never makes more of them,
    so the start should fit the largest shuffle: some 500,000 for 100 TB.
    """
    return max(at_least, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "depotflow",
    master: str | None = None,
    largest_shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators are tested under.

    On a cluster the session is normally made by the launcher; nothing in the package
    depends on this function having been used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if largest_shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(largest_shuffle_bytes))
    settings |= conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR_KEY} must name a folder shared by all executors")
    app = context.applicationId
    if app not in _local_fallbacks:
        _local_fallbacks[app] = tempfile.mkdtemp(prefix="depotflow-")
    return _local_fallbacks[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/depotflow/{label}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are done.

    It removes them once the driver has collected what referred to them; by itself the driver does so when its
    heap is full, and files of every job since lie on the executors' disks until then. Frames that were dropped here
    are still held until Python has collected its own garbage, and the last query by Spark's listeners until another comes.
    """
    gc.collect()
    spark.sql("SELECT 1").collect()
    time.sleep(0.1)  # listeners hear of it on a thread of their own
    spark._jvm.System.gc()


def stashed(frame: DataFrame, label: str) -> DataFrame:
    """A frame written to the shared folder and read back, so that its sources may change after."""
    location = scratch_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(location)
    release_shuffles(frame.sparkSession)
    return frame.sparkSession.read.schema(frame.schema).parquet(location)
