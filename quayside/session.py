"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the skew split of the joins in this library, also where a later
# aggregation would need the split partitions shuffled once more.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", app: str = "quayside", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.ui.enabled", "false")
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
