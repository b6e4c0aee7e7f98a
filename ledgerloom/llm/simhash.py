"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import row_key, ship_package, stored
from ledgerloom.operators.joins import lookup

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3

# Shingles whose bits are counted at once, and fingerprints compared by one call.
_SHINGLES_AT_ONCE = 1 << 16
_BLOCK = 1024
# A bucket of more blocks is spread by wider masks: blocks would make more copies of it than masks do.
_HOT_BLOCKS = 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text as an unsigned number.

    A-Z are lower-cased, words end at ASCII white space, shingles are ``words`` words joined by
    one space (a shorter text is one shingle). A bit is 1 if it is set in over half the hashes.
    """
    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    starts, ends = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        some = zip(starts[at : at + _SHINGLES_AT_ONCE], ends[at : at + _SHINGLES_AT_ONCE])
        hashes = np.array([hashed(joined[a:b], seed) for a, b in some], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def simhash(text: Column, words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a signed 64-bit column; null and empty texts have 0."""

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Bit masks of which at least one avoids any given ``radius`` bits.

    Each bit has a label of ``radius + 1`` binary digits; each nonzero vector of as many digits
    gives a mask, with the bits whose label has an odd product with it. ``radius`` labels leave a
    nonzero vector orthogonal to all of them, so the mask of that vector holds none of those
    bits. All labels but zero are dealt out in turn, so every mask keeps about half the bits.
    """
    vectors = range(1, 1 << (radius + 1))
    labels = [vectors[i % len(vectors)] for i in range(bits)]
    return [sum(1 << i for i, label in enumerate(labels) if (label & v).bit_count() % 2) for v in vectors]


def wider_masks(mask: int, radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The mask with more bits: covering masks over those it leaves out are added to it."""
    free = [i for i in range(bits) if not mask >> i & 1]
    inner = covering_masks(radius, len(free))
    return [mask | sum(1 << bit for i, bit in enumerate(free) if m >> i & 1) for m in inner]


def star_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(smallest member, other member) of each group of fingerprints linked within ``radius``."""
    values = np.unique(values)
    raw = values.view(np.uint64)
    rest = np.ones(len(values), bool)
    links = []
    for root in range(len(values)):
        if not rest[root]:
            continue
        rest[root] = False
        reached, todo = [], [root]
        while todo:
            near = rest & (np.bitwise_count(raw ^ raw[todo.pop()]) <= radius)
            found = np.flatnonzero(near).tolist()
            rest[found] = False
            reached += found
            todo += found
        links += [(int(values[root]), int(values[other])) for other in reached]
    return links


def _links_of(values: Column, radius: int) -> Column:
    @F.pandas_udf("array<struct<a:bigint,b:bigint>>")
    def of(groups: pd.Series) -> pd.Series:
        return pd.Series([
            [{"a": a, "b": b} for a, b in star_links(np.asarray(g, dtype=np.int64), radius)] for g in groups
        ])

    return of(values)


def near_links(
    prints: DataFrame, radius: int = RADIUS, block: int = _BLOCK, hot_blocks: int = _HOT_BLOCKS
) -> DataFrame:
    """Links (a, b) that join all fingerprints at ``radius`` or fewer differing bits into groups.

    ``prints`` has distinct values ``fp``. Two such fingerprints share their bits under a covering
    mask and so meet in a bucket of it. A bucket of more than ``block`` values is dealt into
    blocks, and each two blocks meet in a task of their own, so no task holds a large group.
    A bucket of more than ``hot_blocks`` blocks is spread anew by masks that also keep some of the
    bits its own mask leaves out; with three bits, 16 of 64 stay out, so such a bucket has at most
    65,536 values, and the work grows with the fingerprints however many meet in a bucket. Each meeting gives the links of a star per group instead of all pairs.
    """
    masks = covering_masks(radius)
    spread = prints.select("fp", F.inline(F.array(*[_place(i, F.lit(m)) for i, m in enumerate(map(_signed, masks))])))
    met = _met(spread)
    hot = F.col("_n") > hot_blocks * block
    deeper = F.array(*[F.array(*[F.lit(_signed(m)) for m in wider_masks(mask, radius)]) for mask in masks])
    below = F.transform(F.get(deeper, F.col("mask").cast("int")), lambda m, i: _place((F.col("mask") + 1) * len(masks) + i, m))
    again = _met(met.where(hot).select("fp", F.inline(below)))
    groups = _meetings(met.where(~hot).unionByName(again), block)
    return groups.select(F.inline(_links_of(F.col("_group"), radius))).distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _place(number: Column | int, mask: Column) -> Column:
    """The bucket of a fingerprint under a mask."""
    kept = F.col("fp").bitwiseAND(mask.cast("bigint"))
    return F.struct(F.lit(number).cast("int").alias("mask"), kept.alias("kept"))


def _met(spread: DataFrame) -> DataFrame:
    """The fingerprints of buckets with more than one, and how many it has."""
    sizes = spread.groupBy("mask", "kept").agg(F.count("*").alias("_n")).where("_n > 1")
    return lookup(spread, sizes, ["mask", "kept"], "inner")


def _meetings(met: DataFrame, block: int) -> DataFrame:
    """The members of each two blocks of a bucket, in ``_group``."""
    n_blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), n_blocks).cast("int")
    meetings = F.transform(
        F.sequence(F.lit(0), n_blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")),
    )
    groups = (
        met.select("mask", "kept", "fp", F.inline(meetings))
        .groupBy("mask", "kept", "low", "high")
        .agg(F.collect_list("fp").alias("_group"))
        .where(F.size("_group") > 1)
    )
    return groups


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected to, ``root``, for all nodes but the roots.

    Alternates two steps until nothing changes: each node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones. Every step keeps the components and writes the
    links to the shared folder; the number of steps grows with the logarithm of the component size.
    """
    links = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    links = stored(links.where("node != root").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(node, root))")).first()
        if state == before or state[0] == 0:
            return links
        before = state
        both = links.union(links.select("root", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = lookup(both.where("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = lookup(large, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = handed.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        links = stored(small.toDF("node", "root"), "links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """Documents with the group of near-duplicates each one is in.

    Returns id, ``fingerprint`` (16 hex digits) and ``component_id``: the smallest id that links
    of at most ``radius`` differing bits lead to. A row per input row. Texts that are null or
    hold no word have fingerprint zero and are linked like any other. A null id counts as no id:
    its row gets the smallest id of its group, or null if the group has none. Other columns take
    no part. ``row_key`` is a hash of id and text, and ``is_first`` marks the row of a group with
    the smallest id (then key; a row that is repeated is marked each time). Runs jobs when called.
    """
    ship_package(docs.sparkSession)
    prints = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
            simhash(F.col(text_col), words, seed).alias("fp"),
        ),
        "simhash",
    )
    # Rows without id come after all others.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("_least")
    distinct = stored(prints.groupBy("fp").agg(least), "simhash-distinct")
    roots = smallest_reachable(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("_least").alias("_first"))
    known = lookup(rooted.select("fp", "root"), smallest, ["root"]).select("fp", "_first")
    first = F.col("_first")
    return lookup(prints, known, ["fp"]).select(
        "doc_id",
        as_hex(F.col("fp")).alias("fingerprint"),
        first.doc_id.alias("component_id"),
        "row_key",
        (F.col("doc_id").eqNullSafe(first.doc_id) & (F.col("row_key") == first.row_key)).alias("is_first"),
    )
