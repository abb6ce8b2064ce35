"""Session used by the tests and the benchmark.

Jobs on a cluster bring their own session; nothing in the operators depends on this one.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from brightloom.unions import guard


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "brightloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BRIGHTLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    guard(spark)
    return spark
