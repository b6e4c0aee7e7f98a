"""The log append as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.ids import assign_ids
from ledgerloom.plans.storage import files_in, is_file, read_text, write_file


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream the Parquet files of a folder; ``files`` picks them by name."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def without_repeats(entries: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Drop entries that a source sent again within ``delay`` of their time.

    State is kept for ``delay`` only. An entry that comes later than that is dropped by Spark,
    so choose the delay from the source, or leave this step out if the source never repeats.
    """
    # Watermarks need a zoned time; the column of the entry stays as it is.
    timed = entries.withColumn("_event_time", F.col(time).cast("timestamp"))
    unique = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(key)
    return unique.drop("_event_time")


def append_stream(
    entries: DataFrame,
    to_log: Callable[[DataFrame], DataFrame],
    log_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Append the entries available now to the log, each once; run again to go on.

    The file sink commits a batch once even if it is run again, and the checkpoint remembers
    the files read, so a restart adds nothing twice. Ids come from the source: numbering the
    rows of an endless stream would need one task to see them all.
    """
    return (
        to_log(entries)
        .writeStream.format("parquet")
        .option("path", log_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _batch_start(spark: SparkSession, log_path: str, batch: int, count: Callable[[], int]) -> int:
    """The highest id before a batch, the same however often the batch runs.

    The first run of a batch notes where its ids start and how many they are, before it writes them.
    """
    notes = f"{log_path}/_starts"
    own = f"{notes}/{batch:020d}"
    if not is_file(spark, own):
        earlier = [name for name in files_in(spark, notes) if int(name) < batch]
        before = sum(map(int, read_text(spark, f"{notes}/{max(earlier)}").split())) if earlier else 0
        write_file(spark, own, f"{before} {count()}")
    return int(read_text(spark, own).split()[0])


def append_numbered_stream(
    entries: DataFrame,
    to_log: Callable[[DataFrame], DataFrame],
    key: list[str],
    log_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Append the entries available now to the log, with ids that go on from batch to batch.

    ``to_log`` gives log rows; their ``id`` is replaced. ``key`` names columns of them, not null
    together, that tell the rows of a batch apart. Ids are dense over all batches. The number of a batch is its
    commit key: a batch that runs again after a failure takes the same ids and replaces what it
    wrote. The rows of a batch lie in a folder of their own, ``batch=<number>``.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = to_log(batch)
        names = rows.columns
        start = _batch_start(batch.sparkSession, log_path, number, rows.count)
        numbered = assign_ids(rows, key, start, id_col="_numbered").withColumn("id", F.col("_numbered"))
        numbered.select(*names).write.mode("overwrite").parquet(f"{log_path}/batch={number}")

    return (
        entries.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
