"""A session for tests, checks and the bench. On a cluster, bring your own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | str = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        # the default of 10,000 tasks to list folders suits a cluster, not one machine
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
