"""Session helper for local runs, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A local session with adaptive execution on, and shared as spark.checkpoint.dir; on a cluster, the caller brings its own."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quern")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()
