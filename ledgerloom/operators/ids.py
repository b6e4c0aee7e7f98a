"""Surrogate ids and ranks without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.storage import new_folder


def next_id_base(table: DataFrame, id_col: str = "id") -> Column:
    """Largest id in use as a scalar subquery, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


# Buckets whose counts are summed by one task.
_BUCKETS_PER_SUM = 1024

# Leading bits of the hash that buckets can be made of.
_HASH_BITS = 28


def _offsets(counts: DataFrame, bucket: str, names: list[str]) -> DataFrame:
    """Totals of the buckets before each one, for integer buckets with a row each.

    In two levels: inside runs of neighbouring buckets, and over the totals of the runs, so that
    no task sums more than a small part of the buckets.
    """
    run = F.floor(F.col(bucket) / _BUCKETS_PER_SUM).alias("_run")
    runs = counts.groupBy(run).agg(*[F.sum(n).alias(f"_run_{n}") for n in names])
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = runs.select("_run", *[F.sum(f"_run_{n}").over(before).alias(f"_far_{n}") for n in names])
    near = Window.partitionBy("_run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("_run", run).withColumns({f"_near_{n}": F.sum(n).over(near) for n in names})
    zero = F.lit(0)
    total = [
        (F.coalesce(f"_far_{n}", zero) + F.coalesce(f"_near_{n}", zero)).alias(f"_before_{n}") for n in names
    ]
    return inside.join(earlier, "_run").select(bucket, *total)


def assign_ids(
    rows: DataFrame,
    key: list[str],
    start: Column | int = 0,
    id_col: str = "id",
    where: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add dense ids ``start + 1 ...`` to rows with a unique ``key``, in the order of md5(key).

    The leading bits of the hash make even buckets, eight or more per shuffle partition unless
    ``buckets`` says how many (rounded up to a power of two); an id is the number of rows in
    earlier buckets plus the rank inside the own bucket. The ids depend only on the keys, not on
    partitioning or on ``buckets``, so a recomputed task gives the same ones.
    With ``where``, only those rows get an id, the others null.
    """
    if buckets is None:
        buckets = 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, buckets - 1).bit_length()
    if not 0 <= bits <= _HASH_BITS:
        raise ValueError(f"at most 2 ** {_HASH_BITS} buckets")
    wanted = F.lit(True) if where is None else where
    digest = F.md5(F.concat_ws("\u001f", *[F.col(k).cast("string") for k in key]))
    prefix = F.conv(F.substring("_digest", 1, _HASH_BITS // 4), 16, 10).cast("bigint")
    bucketed = rows.select("*", digest.alias("_digest"), wanted.alias("_wanted")).withColumn(
        "_bucket", F.shiftright(prefix, _HASH_BITS - bits)
    )
    counts = bucketed.where("_wanted").groupBy("_bucket").agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy("_bucket").orderBy(F.desc("_wanted"), "_digest", *key)
    ranked = bucketed.withColumn("_rank", F.row_number().over(ordered))
    joined = ranked.join(_offsets(counts, "_bucket", ["_n"]), "_bucket", "left")
    base = start if isinstance(start, Column) else F.lit(start)
    value = F.when(F.col("_wanted"), (base + F.col("_before__n") + F.col("_rank")).cast("bigint"))
    return joined.select(*rows.columns, value.alias(id_col))


def running_sums(rows: DataFrame, order: list[Column | str], sums: dict[str, Column]) -> DataFrame:
    """Add, per name in ``sums``, the total of its value over all rows before a row in ``order``.

    The order has to be total up to rows that are the same. This runs a job: the rows are
    range-partitioned and written to the shared folder, which fixes the partition of each row.
    The total before a row is that of the earlier partitions plus that inside its own.
    """
    names = list(sums)
    values = {f"_value_{n}": sums[n] for n in names}
    ranged = rows.withColumns(values).repartitionByRange(*order)
    folder = new_folder(rows.sparkSession, "ranged")
    numbered = ranged.withColumn("_range", F.spark_partition_id())
    numbered.write.parquet(folder)
    stored = rows.sparkSession.read.schema(numbered.schema).parquet(folder)
    counts = stored.groupBy("_range").agg(*[F.sum(f"_value_{n}").alias(n) for n in names])
    offsets = _offsets(counts, "_range", names)
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = {f"_own_{n}": F.coalesce(F.sum(f"_value_{n}").over(inside), F.lit(0)) for n in names}
    joined = stored.withColumns(own).join(offsets, "_range")
    total = [(F.col(f"_own_{n}") + F.col(f"_before_{n}")).alias(n) for n in names]
    return joined.select(*[F.col(c) for c in rows.columns], *total)


def ordered_rank(rows: DataFrame, order: list[str], rank_col: str) -> DataFrame:
    """Add the 1-based position in the order of the (unique) columns ``order``.

    Like ``running_sums``, this runs a job when it is called.
    """
    counted = running_sums(rows, order, {rank_col: F.lit(1)})
    return counted.withColumn(rank_col, (F.col(rank_col) + 1).cast("bigint"))
