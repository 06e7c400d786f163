"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Read and write instants as UTC: every calendar date of the model is a UTC date."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the session is given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paceforge")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
