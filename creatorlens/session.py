"""Session settings sized to the input and the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

_MB = 1024 * 1024
_PARTITION_BYTES = 128 * _MB
_MAX_SHUFFLE_PARTITIONS = 50_000


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark SQL settings for an input of ``input_bytes`` on ``cores`` task slots.

    Scans get about fifty tasks per core, of 4 to 512 MB. Shuffles start with up to
    50,000 partitions, at least one per core; adaptive execution merges small ones
    and splits skewed ones. Timestamps and the current date are UTC.
    """
    cores = max(cores, 1)
    shuffles = min(-(-input_bytes // _PARTITION_BYTES), _MAX_SHUFFLE_PARTITIONS)
    scan = min(max(input_bytes // (cores * 50), 4 * _MB), 512 * _MB)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(max(cores, shuffles)),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }


def apply(spark: SparkSession, input_bytes: int, cores: int | None = None) -> SparkSession:
    for name, value in settings(input_bytes, cores or spark.sparkContext.defaultParallelism).items():
        spark.conf.set(name, value)
    return spark
