"""Spark settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only: safe to set on a session that is already running.
RUNTIME_CONF = {
    # every date rule is written against UTC days
    "spark.sql.session.timeZone": "UTC",
    # hot accounts and payers: split skewed join partitions at run time
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Add the settings to a session builder.

    ``shuffle_partitions`` is the upper number of reducers; adaptive execution
    merges small ones, so on a cluster set it for the largest report
    (about shuffle bytes / 128 MB).
    """
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Apply the same settings to a session made by someone else."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
