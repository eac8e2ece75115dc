"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache
from math import ceil

from pyspark.sql import SparkSession

MIB = 1024**2
# Bytes one shuffle task should hold: small enough to sort in one core's share of executor memory.
SHUFFLE_TASK_BYTES = 200 * MIB
# Above this many tasks the blocks between map and reduce side get too small and the driver's table of
# them too large; then tasks grow instead, and sorts and aggregates spill.
MAX_SHUFFLE_TASKS = 50_000
SCAN_TASK_BYTES = (256 * MIB, 1024 * MIB)


def recommended_settings(
    shuffle_bytes: int,
    total_cores: int,
    max_shuffle_tasks: int = MAX_SHUFFLE_TASKS,
    scan_task_bytes: tuple[int, int] = SCAN_TASK_BYTES,
) -> dict[str, str]:
    """Spark settings for a job whose largest shuffle moves about ``shuffle_bytes``.

    The shuffle starts wide and AQE merges what turns out to be small, splits skewed join partitions and
    switches to broadcast joins by measured size. Before a measurement exists Spark goes by file sizes;
    Parquet grows in memory, so those are multiplied before they are held against the broadcast limit.
    """
    wanted = ceil(shuffle_bytes / SHUFFLE_TASK_BYTES)
    partitions = max(total_cores, min(wanted, max_shuffle_tasks))
    task_bytes = max(SHUFFLE_TASK_BYTES, ceil(shuffle_bytes / partitions))
    low, high = scan_task_bytes
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(max(low, task_bytes), high)),
        "spark.sql.sources.fileCompressionFactor": "5.0",
    }


def local_session(cores: int | str = "*", app_name: str = "stratalake", **settings: str) -> SparkSession:
    """A session for tests and the bench."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stratalake-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the cluster's shared folder, for tables a job writes and reads back.

    The shared folder is ``spark.checkpoint.dir``. Only a local session that does not set it gets a
    temporary folder; on a cluster such a folder would exist on one machine only, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
