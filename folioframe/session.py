"""Session helper for local runs and tests; a cluster passes its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "folioframe", cores: str | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # a stack trace for each expression makes plans slow to build
        .getOrCreate()
    )
