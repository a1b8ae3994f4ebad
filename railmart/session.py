"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators count on; keyword settings override them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "railmart", cores: int | None = None, **settings: str) -> SparkSession:
    """A session with the defaults. ``cores`` of the cluster set the number of shuffle partitions AQE starts from.

    Three partitions per core leave room to even out; AQE merges the small ones after each shuffle.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(max(3 * cores, 8)))
    return builder.getOrCreate()
