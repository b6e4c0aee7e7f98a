"""A ledger and counts of its log that follow a stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.values import moment
from ledgerloom.operators.select import LOG_DIMENSIONS, decode
from ledgerloom.plans.storage import (
    files_in,
    is_file,
    new_folder,
    read_text,
    remove_folder,
    subfolders,
    write_file,
    written_tables,
)
from ledgerloom.sources.repository import Repository


def admit_stream(
    repo: Repository,
    requests: DataFrame,
    name: str,
    answers_path: str,
    checkpoint_path: str,
    now: dt.datetime | None = None,
    fix: str | None = None,
) -> StreamingQuery:
    """Admit the run requests available now, and store their runs; run again to go on.

    Requests that come together are handled in the order of ``admit_runs``, after all that came
    before. What is remembered between them, the open run of each key, are the repository's own
    open runs, so runs that other batches enter or repair count as well. A hot key is split over
    tasks as in any batch; state of the stream would hold it in one.

    ``name`` and the number of a micro-batch are the identity of its batch in the request ledger: one
    that runs again after a failure gets the same answers and ids, and stores nothing twice. A stream
    with a new checkpoint needs a new name. Answers lie in ``answers_path``, ``batch=<number>``.
    """

    def admit(batch: DataFrame, number: int) -> None:
        with written_tables(repo.spark):
            # Written because they are read twice; and Spark plans the rows of a stream without AQE.
            folder = new_folder(repo.spark, "live-requests")
            batch.write.parquet(folder)
            asked = repo.spark.read.schema(batch.schema).parquet(folder)
            answers = repo.apply_runs(asked, now, fix, batch=f"{name}-{number}")
            answers.write.mode("overwrite").parquet(f"{answers_path}/batch={number}")

    return (
        requests.writeStream.foreachBatch(admit)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


_GROUP = ["hour", "log_level_id", "migration_event_id", "run_mode_id"]


def _hour(time: Column) -> Column:
    """The hour of a time without zone; null stays null."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(time), F.month(time), F.day(time), F.hour(time), zero, zero)


def log_activity(rows: DataFrame, late: Column | None = None) -> DataFrame:
    """Log entries per hour, level, event and run mode, and how many of them are late."""
    return rows.groupBy(_hour(F.col("created_at")).alias("hour"), *_GROUP[1:]).agg(
        F.count("*").alias("n_entries"),
        F.count_if(F.lit(False) if late is None else late).alias("n_late"),
        F.max("created_at").alias("newest"),
    )


class LogActivity:
    """Counts of a log by hour that a stream keeps up to date.

    Each micro-batch is counted in its tasks and adds a folder of counts; a note, written last, makes
    it count, and holds the newest time so far. An entry is late if it is more than ``delay`` older
    than the newest one of the micro-batches before. Late entries are counted as such and are not
    dropped, so the sums are those of the whole log however it arrives. Entries without a time have
    the hour null and are never late. A micro-batch that runs again replaces its counts.

    After ``merge_every`` micro-batches the counts are added up into one folder, so reading does not
    grow with their number; ``vacuum`` removes what was added up.
    """

    def __init__(self, spark: SparkSession, folder: str, delay: dt.timedelta, merge_every: int = 100):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.delay = delay
        self.merge_every = merge_every

    def start(
        self, entries: DataFrame, to_log: Callable[[DataFrame], DataFrame], checkpoint_path: str
    ) -> StreamingQuery:
        """Count the entries available now; run again to go on."""

        def add(batch: DataFrame, number: int) -> None:
            self.add(to_log(batch), number)

        return (
            entries.writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )

    def add(self, rows: DataFrame, number: int) -> None:
        """Count the log rows of one micro-batch."""
        before = self._newest_before(number)
        late = None if before is None else F.col("created_at") < moment(before - self.delay)
        folder = f"{self.folder}/counts/{number:020d}"
        log_activity(rows, late).write.mode("overwrite").parquet(folder)
        if number not in self._noted():
            newest = self.spark.read.parquet(folder).agg(F.max("newest")).first()[0]
            known = [time for time in (before, newest) if time is not None]
            write_file(self.spark, self._note(number), max(known).isoformat() if known else "")
        merged, parts = self._parts()
        if len(parts) >= self.merge_every:
            self._sums().write.mode("overwrite").parquet(f"{self.folder}/merged/{max(parts):020d}")

    def read(self, dims: dict[str, DataFrame]) -> DataFrame:
        """The counts so far, with the names of events and run modes."""
        return decode(self._sums().drop("newest"), dims, LOG_DIMENSIONS)

    def vacuum(self) -> None:
        """Remove counts that were added up; nothing may still read them."""
        merged, _ = self._parts()
        if merged is None:
            return
        for kind, last in (("counts", merged), ("merged", merged - 1)):
            for folder in subfolders(self.spark, f"{self.folder}/{kind}"):
                if int(folder.rstrip("/").rsplit("/", 1)[-1]) <= last:
                    remove_folder(self.spark, folder)

    def _note(self, number: int) -> str:
        return f"{self.folder}/notes/{number:020d}"

    def _noted(self) -> list[int]:
        return [int(name) for name in files_in(self.spark, f"{self.folder}/notes")]

    def _newest_before(self, number: int) -> dt.datetime | None:
        earlier = [n for n in self._noted() if n < number]
        text = read_text(self.spark, self._note(max(earlier))) if earlier else ""
        return dt.datetime.fromisoformat(text) if text else None

    def _parts(self) -> tuple[int | None, list[int]]:
        """The last micro-batch that was added up, and the noted ones after it."""
        names = [f.rstrip("/").rsplit("/", 1)[-1] for f in subfolders(self.spark, f"{self.folder}/merged")]
        whole = [int(n) for n in names if is_file(self.spark, f"{self.folder}/merged/{n}/_SUCCESS")]
        merged = max(whole, default=None)
        return merged, [n for n in self._noted() if merged is None or n > merged]

    def _sums(self) -> DataFrame:
        merged, parts = self._parts()
        folders = [f"{self.folder}/counts/{n:020d}" for n in parts]
        if merged is not None:
            folders.append(f"{self.folder}/merged/{merged:020d}")
        if not folders:
            kinds = "hour timestamp_ntz, log_level_id smallint, migration_event_id int, run_mode_id smallint"
            counts = "n_entries bigint, n_late bigint, newest timestamp_ntz"
            return self.spark.createDataFrame([], f"{kinds}, {counts}")
        return (
            self.spark.read.parquet(*folders)
            .groupBy(*_GROUP)
            .agg(
                F.sum("n_entries").alias("n_entries"),
                F.sum("n_late").alias("n_late"),
                F.max("newest").alias("newest"),
            )
        )
