"""The local session of tests, checks and the benchmark."""

import os

from pyspark.sql import SparkSession

from tidelist.session import configure


def make_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelist")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")  # many small plans, over and over
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
