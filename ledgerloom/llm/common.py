"""Helpers that several text operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.storage import stored as stored

# Words are runs of anything but the six ASCII white-space characters.
SPACED_WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and all other characters as they are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: Column) -> Column:
    """A 128-bit key of a row, a pair of hashes with different seeds; never null, equal for rows that
    are the same in these columns."""
    both = F.struct(*[F.xxhash64(F.lit(seed), *columns).alias(name) for seed, name in ((1, "a"), (2, "b"))])
    # As it is read back from a file; otherwise joins would cast it and shuffle once more.
    return both.cast("struct<a:bigint,b:bigint>")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers may not have it on their path."""
    name = "ledgerloom-package.zip"
    if any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), name)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
