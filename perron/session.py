"""Session defaults for local runs, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **options: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the submitted session is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("perron")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PERRON_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="perron-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/perron/{name}-{uuid.uuid4().hex}"
