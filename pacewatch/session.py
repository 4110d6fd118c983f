"""Session settings for tests and benchmarks, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pacewatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoints(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint`` has a folder and return it.

    A cluster names a shared folder in ``spark.checkpoint.dir``. A temporary folder is
    used only in local mode, where the driver is the only machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None or (shared and not current.startswith(shared)):
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(shared)
        current = shared
    return current
