"""Local Spark session for tests and checks."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(cpus: str = "8") -> SparkSession:


    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("voxweave-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
