"""High-water marks: the highest id given out for a table, kept beside it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.plans.storage import create_file, files_in, read_text, remove_folder


class HighWater:
    """Ranges of ids for the writers of one table, each given out once.

    A claim is a small file, named by the highest id before it, with the number of ids it takes.
    It is created only if it is not there, so of two writers that want the same range one gets it
    and the other one looks again. Claims are made before rows are written: a writer that fails
    leaves a gap and never an id that is used twice. Only the last claims are kept.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _claims(self) -> list[str]:
        return sorted(files_in(self.spark, self.folder))

    def top(self) -> int | None:
        """The highest id given out; none if nothing was ever claimed."""
        claims = self._claims()
        if not claims:
            return None
        name = claims[-1]
        taken = read_text(self.spark, f"{self.folder}/{name}")
        # The writer of an empty claim failed before it could use an id.
        return int(name) + (int(taken) if taken else 1)

    def _claim(self, before: int, n: int) -> bool:
        old = self._claims()[:-1]
        if not create_file(self.spark, f"{self.folder}/{before:020d}", str(n)):
            return False
        for name in old:
            remove_folder(self.spark, f"{self.folder}/{name}")
        return True

    def reserve(self, n: int) -> int:
        """Take ``n`` ids; returns the one before the first of them."""
        while True:
            before = self.top() or 0
            if n == 0 or self._claim(before, n):
                return before

    def raise_to(self, top: int | None) -> None:
        """Count ids up to ``top`` as given out."""
        while top is not None and (self.top() or 0) < top:
            before = self.top() or 0
            if self._claim(before, top - before):
                return
