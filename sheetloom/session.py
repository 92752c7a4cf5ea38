"""A session for local runs; on a cluster the caller brings its own."""

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "sheetloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SHEETLOOM_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
