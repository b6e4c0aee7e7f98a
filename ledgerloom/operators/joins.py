"""Joins against tables with unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.storage import stored

_TAG = "_key_tag"


def lookup(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join many rows, with hot keys, to a table that has each key at most once.

    ``table`` usually comes out of an aggregation and is already partitioned by ``on``. Spark
    would keep that partitioning, and AQE splits a hot partition only where both sides have an
    exchange of their own. Joining on a hash of the key as well gives both sides one: a hot key
    in ``rows`` is then split over many tasks, and a table found small at run time is broadcast.
    """
    tag = F.xxhash64(*on).alias(_TAG)
    joined = rows.select("*", tag).join(table.select("*", tag), [_TAG, *on], how)
    return joined.drop(_TAG)


# Values that are sent to a scan as a condition.
FEW_VALUES = 200


def few_values(asked: DataFrame, column: str, most: int = FEW_VALUES) -> list | None:
    """The distinct values of a column without null, or nothing if there are more than ``most``."""
    values = asked.select(column).where(F.col(column).isNotNull()).distinct()
    found = values.limit(most + 1).collect()
    return [row[0] for row in found] if len(found) <= most else None


def any_of(column: str, values: list) -> Column:
    """Whether the column has one of a few values.

    Equalities, because of a longer ``IN`` list only the least and the largest value reach the
    statistics and Bloom filters of Parquet files.
    """
    terms = [F.col(column) == F.lit(v) for v in values] or [F.lit(False)]
    while len(terms) > 1:  # halves, so the condition stays flat
        terms = [a | b for a, b in zip(terms[::2], terms[1::2], strict=False)] + terms[len(terms) & ~1 :]
    return terms[0]


# Keys that every task gets as they are.
FEW_KEYS = 10_000

# A key filter has blocks of 2 ** 15 bits, at least 24 bits per key, and up to 32 MB, in which a key has
# three bits of one block.
_BLOCK_BITS = 15
_BITS_PER_KEY = 24
_MOST_BLOCKS = 2**13


def _block(n_blocks: int) -> Column:
    return F.col("_hash").bitwiseAND(F.lit(n_blocks - 1))


def _places() -> list[Column]:
    """The places of a key in its block, from bits of its hash that don't choose the block."""
    return [F.shiftrightunsigned("_hash", at).bitwiseAND(F.lit(2**_BLOCK_BITS - 1)).cast("int") for at in (16, 31, 46)]


def _key_filter(keys: DataFrame, on: list[str], n_blocks: int) -> DataFrame:
    """A Bloom filter of keys: its blocks, as arrays of 64-bit words."""
    bits = keys.select(F.xxhash64(*on).alias("_hash")).select(
        _block(n_blocks).alias("_block"), F.explode(F.array(*_places())).alias("_place")
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_place").bitwiseAND(F.lit(63)))
    words = bits.groupBy("_block", F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    known = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_known"))
    every = F.sequence(F.lit(0), F.lit(2 ** (_BLOCK_BITS - 6) - 1))
    return known.select(
        "_block",
        F.transform(every, lambda i: F.coalesce(F.col("_known")[i], F.lit(0).cast("bigint"))).alias("_words"),
    )


def with_keys(rows: DataFrame, asked: DataFrame, on: list[str], few: int = FEW_KEYS) -> DataFrame:
    """The rows of wide ``rows`` whose key is in ``asked``, which has each key once and is read several times.

    Wide rows are not shuffled: they pass a Bloom filter that every task gets. The keys that pass it and
    are not asked for are found on the narrow key columns and taken out by an anti join, for which Spark
    broadcasts them unless they are many; so the result is that of the semi join. Runs jobs.
    """
    asked = asked.select(*on).dropna()
    n = asked.count()
    if n <= few:
        return rows.join(F.broadcast(asked), on, "left_semi")
    n_blocks = min(_MOST_BLOCKS, 1 << (n * _BITS_PER_KEY >> _BLOCK_BITS).bit_length())
    blocks = stored(_key_filter(asked, on, n_blocks), "key-filter")

    def likely(some: DataFrame) -> DataFrame:
        hashed = some.dropna(subset=on).withColumn("_hash", F.xxhash64(*on))
        met = _block(n_blocks) == F.col("_block")
        for place in _places():
            met &= F.getbit(F.col("_words")[F.shiftright(place, 6)], place.bitwiseAND(F.lit(63))) == 1
        return hashed.join(F.broadcast(blocks), met, "left_semi").drop("_hash")

    others = likely(rows.select(*on)).distinct()
    return lookup(likely(rows), stored(lookup(others, asked, on, "left_anti"), "other-keys"), on, "left_anti")
