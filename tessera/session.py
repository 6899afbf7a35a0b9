"""Session defaults for local work; on a cluster the submitted configuration wins."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "tessera", cores: int | None = None, partitions: int = 8) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
