"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wide projections compile to methods longer than 8000 bytes, which the JVM only
# interprets; below this limit Spark splits them into short ones instead.
# Candidates compress to some bytes a row, so a task of Spark's 64 MB holds millions
# of rows in memory; with 8 MB its memory stays the same for any size of input.
RUNTIME_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
#: Parts of a shuffle before small ones are put together, as many as need no sorting by part.
LEAST_PARTS, PARTS = 200, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that a running session can still take and has not set itself."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    if spark.sparkContext.getConf().get(PARTS) is None:
        spark.conf.set(PARTS, str(max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def local_session(cores: int | str = "*", app: str = "basketrank") -> SparkSession:
    """A local session for tests and measurements."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
