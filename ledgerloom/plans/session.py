"""A session with the settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE splits hot partitions of joins and picks broadcasts from sizes measured at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Bytes of input per shuffle partition: small enough to sort in an executor's memory.
_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Partitions for shuffling the whole input: one per 128 MB, but at least one per core.

    AQE merges the ones that turn out small, so too many cost little and too few spill.
    """
    return max(cores, -(-input_bytes // _PARTITION_BYTES))


def build_session(
    app: str = "ledgerloom", master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session for this library; with ``input_bytes``, its shuffles are sized for so much input."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        n = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return spark
