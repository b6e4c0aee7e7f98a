"""The current state of migrations, kept up to date with their history bucket by bucket."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.changes import newest_history
from ledgerloom.plans.storage import files_in, read_text, remove_folder, subfolders, write_file
from ledgerloom.sources.tables import struct_type

BUCKETS = 256

_BODY = [f.name for f in struct_type("migration").fields if f.name != "id"]


class CurrentState:
    """The newest history row of each migration, in buckets by migration id.

    New history is merged into the buckets it falls on; the files of all others stay as they are.
    Merged buckets are written to a new folder, and a manifest, which names the folder of every
    bucket, is written last: until then readers see the state before. The same history merged
    again, or history that comes late, changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark = spark
        self.folder = folder
        self.buckets = buckets

    def _manifests(self) -> list[str]:
        return sorted(files_in(self.spark, f"{self.folder}/manifests"))

    def _versions(self) -> dict[int, str]:
        """The folder that holds each bucket with rows; at most one entry per bucket."""
        names = self._manifests()
        if not names:
            return {}
        lines = read_text(self.spark, f"{self.folder}/manifests/{names[-1]}").splitlines()
        if int(lines[0]) != self.buckets:
            raise ValueError(f"the state is kept in {lines[0]} buckets")
        return {int(bucket): version for bucket, version in (line.split() for line in lines[1:])}

    def _read(self, versions: dict[int, str]) -> DataFrame:
        """The rows of some buckets, as history rows."""
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in struct_type("migration_history").fields])
        if not versions:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.folder}/versions/{version}/bucket={bucket}" for bucket, version in versions.items()]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The current state of all migrations."""
        return self._read(self._versions()).select(F.col("migration_id").alias("id"), *_BODY)

    def merge(self, history: DataFrame) -> list[int]:
        """Merge history rows, reduced to the newest of each migration; returns the buckets written.

        Reads the history twice. One writer at a time merges.
        """
        bucket = F.pmod(F.xxhash64("migration_id"), F.lit(self.buckets)).cast("int")
        names = struct_type("migration_history").names
        new = newest_history(history.select(*names)).withColumn("bucket", bucket)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # bounded by the buckets
        if not touched:
            return []
        versions = self._versions()
        old = self._read({b: versions[b] for b in touched if b in versions}).withColumn("bucket", bucket)
        merged = newest_history(old.unionByName(new))
        version = uuid.uuid4().hex
        # By range: a bucket may be written by several tasks.
        ordered = merged.repartitionByRange("bucket", "migration_id").sortWithinPartitions("bucket", "migration_id")
        ordered.write.partitionBy("bucket").parquet(f"{self.folder}/versions/{version}")
        now = {**versions, **dict.fromkeys(touched, version)}
        lines = [str(self.buckets), *(f"{b} {v}" for b, v in sorted(now.items()))]
        last = self._manifests()[-1:]
        number = int(last[0]) + 1 if last else 1
        write_file(self.spark, f"{self.folder}/manifests/{number:020d}", "\n".join(lines))
        return touched

    def vacuum(self) -> None:
        """Delete what the last manifest does not name; no query may still read it."""
        for name in self._manifests()[:-1]:
            remove_folder(self.spark, f"{self.folder}/manifests/{name}")
        versions = self._versions()
        for version in subfolders(self.spark, f"{self.folder}/versions"):
            name = version.rstrip("/").rsplit("/", 1)[-1]
            for bucket in subfolders(self.spark, version):
                if versions.get(int(bucket.rsplit("=", 1)[-1])) != name:
                    remove_folder(self.spark, bucket)
            if not subfolders(self.spark, version):
                remove_folder(self.spark, version)
