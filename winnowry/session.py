"""Session defaults for local runs; a cluster brings its own session."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

FOLDER = "winnowry.folder"
BUFFER_SETTING, BUFFER = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
SHUFFLE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = 8, app: str = "winnowry") -> SparkSession:
    """A local session with AQE on, UTC time and one shuffle partition per core."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WINNOWRY_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_buffers(spark: SparkSession) -> None:
    """Hand rows to Python in batches of 8 MB instead of Spark's 64, unless the session has chosen a size."""
    if spark.conf.get(BUFFER_SETTING).rstrip("bB") == str(64 << 20):
        spark.conf.set(BUFFER_SETTING, str(BUFFER))


def short_shuffles(spark: SparkSession) -> None:
    """Have shuffle files deleted when their query ends: what later queries read is staged."""
    spark.conf.set(SHUFFLE_SETTING, "true")


def use_folder(spark: SparkSession, path: str) -> None:
    """Name the folder for intermediate tables; one that ``spark.checkpoint.dir`` names goes first."""
    spark.conf.set(FOLDER, path)


def use_local_folder(spark: SparkSession) -> None:
    """For tests and registered queries: name a folder of this machine if none is named.

    Only a local session gets one; on a cluster other executors would not see it.
    """
    if folder_of(spark) is None and spark.sparkContext.master.split("[")[0] == "local":
        use_folder(spark, f"/tmp/winnowry-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}")


def folder_of(spark: SparkSession) -> str | None:
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return configured or spark.conf.get(FOLDER, None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, as named by ``spark.checkpoint.dir`` or ``use_folder``."""
    folder = folder_of(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir, or call use_folder, to name a folder shared by all executors")
    return folder
