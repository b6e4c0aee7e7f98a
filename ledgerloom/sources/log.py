"""Appending to the log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.values import moment
from ledgerloom.operators.ids import assign_ids, next_id_base
from ledgerloom.sources.tables import TABLES, struct_type


def log_rows(
    entries: DataFrame, log: DataFrame | int, key: list[str], now: dt.datetime | None = None
) -> DataFrame:
    """Log rows for new entries: the store adds the id and the time.

    ``key`` names columns that tell the entries apart. Ids continue after those in ``log``, or after
    the given one; then no log is read.
    """
    base = log if isinstance(log, int) else next_id_base(log)
    numbered = assign_ids(entries, key, base).withColumn("created_at", moment(now))
    return numbered.select(
        *[F.col(c.name).cast(c.spark_type).alias(c.name) for c in TABLES["migration_log"]]
    )


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def log_schema() -> T.StructType:
    """Schema for reading a log; files may break ``NOT NULL``, so every column can be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in struct_type("migration_log")])
