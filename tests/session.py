"""Local Spark session for tests and bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def make_session(cpus: str = "8", memory: str = "8g") -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ampline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
