"""Rows laid out by ranges of their keys, those of a large table part by part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.plans.storage import new_folder, settings, subfolders

# Rows that are shuffled at once, and parts of a table with more; a larger table has larger parts.
ROWS_AT_ONCE = 4_000_000
MOST_PARTS = 16

# Bytes that Spark expects of a table at most for it to be laid out at once without counting its rows.
SMALL_BYTES = 64 * 1024 * 1024

# Keys that parts are cut by.
_SAMPLE = 2_000

_PART = "lookup_part"

# Parts are read once: small, but not at the price of a dictionary for each column.
_WRITTEN_AS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}

# A task has a file of each part open, so its rows needn't be sorted by part.
_OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": str(MOST_PARTS + 1)}


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def part_starts(rows: DataFrame, order: list[str]) -> list[tuple]:
    """The first keys of all parts but the first, in order; none if the rows are to be laid out at once.

    Parts are about as large as each other: they are cut by the keys with the least hashes. Runs a job on
    the key columns.
    """
    expected = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if expected <= SMALL_BYTES:
        return []
    counted = Observation()
    keys = rows.select(*order).observe(counted, F.count(F.lit(1)).alias("n"))
    sample = keys.orderBy(F.xxhash64(*order)).limit(_SAMPLE).collect()
    n_parts = min(MOST_PARTS, -(-counted.get.get("n", 0) // ROWS_AT_ONCE))
    # Null comes first, as in the order of rows.
    ordered = sorted(map(tuple, sample), key=lambda key: [(value is not None, value) for value in key])
    starts = (ordered[len(ordered) * i // n_parts] for i in range(1, n_parts))
    return list(dict.fromkeys(starts))


def _part(rows: DataFrame, order: list[str], starts: list[tuple]) -> Column:
    """The number of the part a row is in."""
    key, types = F.struct(*order), dict(rows.dtypes)
    number = F.lit(0)
    for start in starts:
        first = F.struct(*[F.lit(value).cast(types[c]).alias(c) for c, value in zip(order, start)])
        number += F.when(key >= first, 1).otherwise(0)
    return number


def written_parts(rows: DataFrame, order: list[str], starts: list[tuple]) -> list[str]:
    """The rows written to the shared folder, unordered, by part; the folders of the parts in their order."""
    folder = new_folder(rows.sparkSession, "parts")
    split = rows.withColumn(_PART, _part(rows, order, starts))
    with settings(rows.sparkSession, _OPEN_FILES):
        split.write.options(**_WRITTEN_AS).partitionBy(_PART).parquet(folder)
    return sorted(subfolders(rows.sparkSession, folder), key=lambda part: int(part.rsplit("=", 1)[1]))
