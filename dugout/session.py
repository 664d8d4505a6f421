"""Session factory with the settings the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "dugout", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with UTC, ANSI and adaptive execution on.

    ``master`` is for local runs only; on a cluster the submitter sets it. Adaptive
    execution picks broadcast joins from measured sizes and splits skewed join
    partitions, so no module of the library forces a broadcast on data that grows.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Larger generated methods are not compiled by the JVM and run interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("DUGOUT_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()
