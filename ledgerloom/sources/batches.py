"""The request ledger: the stored outcome of every batch, so that a batch counts once."""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.storage import create_file, files_in, is_file, remove_folder, subfolders


class RequestLedger:
    """Outcomes by batch: request_id, result_code, message, id, the new row and what it repairs.

    An outcome is written as a whole before anything is stored by it. A note beside the ledger says
    that its rows are still to be stored; it goes when they are. After a failure the note is there,
    and storing starts again from the written outcome, with the same ids and answers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _batch(self, batch: str) -> str:
        return f"{self.folder}/outcomes/{quote(batch, safe='')}"

    def _read(self, folders: list[str]) -> DataFrame | None:
        whole = [f for f in folders if is_file(self.spark, f"{f}/_SUCCESS")]
        return self.spark.read.parquet(*whole) if whole else None

    def answered(self, batch: str) -> DataFrame | None:
        """The outcome of what was asked in a batch so far."""
        return self._read(subfolders(self.spark, self._batch(batch)))

    def write(self, batch: str, outcome: DataFrame) -> tuple[str, DataFrame]:
        """Write an outcome; returns the note to take back once its rows are stored."""
        attempt = uuid.uuid4().hex
        note = f"{self.folder}/pending/{quote(batch, safe='')}~{attempt}"
        folder = f"{self._batch(batch)}/{attempt}"
        create_file(self.spark, note, "")
        outcome.write.parquet(folder)
        return note, self.spark.read.schema(outcome.schema).parquet(folder)

    def stored(self, note: str) -> None:
        remove_folder(self.spark, note)

    def pending(self) -> list[tuple[str, DataFrame | None]]:
        """Notes of outcomes that may not be stored yet; without an outcome if it was never whole."""
        found = []
        for name in sorted(files_in(self.spark, f"{self.folder}/pending")):
            batch, attempt = name.rsplit("~", 1)
            outcome = self._read([f"{self._batch(unquote(batch))}/{attempt}"])
            found.append((f"{self.folder}/pending/{name}", outcome))
        return found
