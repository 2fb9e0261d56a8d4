"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins from measured sizes, splits skewed join
# partitions and merges small shuffle partitions.  The start number of shuffle
# partitions is set high on a cluster and merged down at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Noting the Python call site of every column doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "daymark", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
