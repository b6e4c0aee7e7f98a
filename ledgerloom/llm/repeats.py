"""Removal of long byte strings that occur more than once, by a bounded BWT interval expansion.

The corpus is cut by content first. Of each stretch of ``min_bytes`` bytes (a window) the smallest
hash of its grams is taken; neighbouring windows with the same hash form a segment. Equal windows
have the same smallest hash, so all places where a window occurs are in segments of one hash,
wherever they stand. Only hashes that come up more than once go on, in two segments or in one. Of equal segments one stands
for all, and the different segments of a hash meet in a task, which sorts their suffixes and
expands intervals on the Burrows-Wheeler transform to find the windows that occur twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, stored
from ledgerloom.operators.joins import lookup

MIN_BYTES = 200

# No byte of this value is in UTF-8 text, so it can part segments.
_SEPARATOR = b"\xff"
# Windows hashed at once, bytes of segments sorted at once, and bytes of one hash in a task.
_WINDOWS_AT_ONCE = 1 << 20
_SORTED_AT_ONCE = 1 << 18
_HOT_BYTES = 1 << 19
# Places of the hash in windows that are compared together first, in hashes of more than one part.
_BLOCK = 16
# Entries of the table of counts per symbol and place; beyond it places are searched.
_COUNT_ENTRIES = 1 << 26


# --- windows, grams and segments -----------------------------------------------------------


def _gram_of(min_bytes: int) -> int:
    return max(1, min_bytes // 4)


def _powers(n: int, base: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed rolling hash of every ``gram`` bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _BASE), out=sums[1:])
    hashes = (sums[gram:] - sums[:-gram]) * _powers(len(data) + 1 - gram, _INVERSE)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def sliding(pick: Callable, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _returning(hashes: np.ndarray, smallest: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Whether the hash of a segment stands at more than one place in it.

    Only then can the segment hold the same window twice.
    """
    edge = np.zeros(width - 1, np.uint64)
    reach = sliding(np.maximum, np.concatenate((edge, smallest, edge)), width)
    places = np.flatnonzero(reach == hashes)  # the smallest of some window
    values, value = np.unique(hashes[places], return_inverse=True)
    n = np.int64(len(hashes) + 1)
    sorted_places = np.sort(value * n + places)
    of = np.searchsorted(values, smallest[starts]) * n
    last = starts + lengths + width - 2
    return np.searchsorted(sorted_places, of + last, "right") - np.searchsorted(sorted_places, of + starts) > 1


def segments(texts: list[bytes], min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first window, windows, hash, digest, whether the hash comes again in it) of
    all segments, in arrays."""
    pieces: list[tuple[int, int, int]] = []
    size = 0
    for number, text in enumerate(texts):
        left, first = len(text) - min_bytes + 1, 0
        while left > 0:
            n = min(left, _WINDOWS_AT_ONCE)
            pieces.append((number, first, n))
            left, first, size = left - n, first + n, size + n
            if size >= _WINDOWS_AT_ONCE:
                yield _segments(texts, pieces, min_bytes)
                pieces, size = [], 0
    if pieces:
        yield _segments(texts, pieces, min_bytes)


def _segments(texts: list[bytes], pieces: list[tuple[int, int, int]], min_bytes: int) -> tuple[np.ndarray, ...]:
    joined = b"".join(texts[number][first : first + n + min_bytes - 1] for number, first, n in pieces)
    numbers, firsts, windows = (np.array(x, np.int64) for x in zip(*pieces))
    offsets = np.cumsum(windows + min_bytes - 1) - (windows + min_bytes - 1)
    gram = _gram_of(min_bytes)
    hashes = gram_hashes(np.frombuffer(joined, np.uint8), gram)
    smallest = sliding(np.minimum, hashes, min_bytes - gram + 1)
    new = np.zeros(len(joined) + 1, bool)
    new[1 : len(smallest)] = smallest[1:] != smallest[:-1]
    new[offsets] = True
    new[offsets + windows] = True  # the windows that would leave a piece
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(joined)))
    piece = np.searchsorted(offsets, starts, "right") - 1
    inside = starts < offsets[piece] + windows[piece]
    starts, lengths, piece = starts[inside], lengths[inside], piece[inside]
    ends = (starts + lengths + min_bytes - 1).tolist()
    digest = xxhash.xxh3_64_intdigest
    digests = np.array([digest(joined[a:b]) for a, b in zip(starts.tolist(), ends)], np.uint64)
    at = firsts[piece] + starts - offsets[piece]
    again = _returning(hashes, smallest, starts, lengths, min_bytes - gram + 1)
    return numbers[piece], at, lengths, smallest[starts].view(np.int64), digests.view(np.int64), again


# --- suffix order and interval expansion ---------------------------------------------------


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes in the order of their first ``depth`` bytes or more, by doubling."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : n + i]
    order, width = np.argsort(key), 8
    while True:
        ordered = key[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        if width >= depth or new.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        key = rank << np.uint64(32)
        if width < n:
            key[: n - width] |= rank[width:]
        order, width = np.argsort(key), width * 2


def common_prefix_bounds(data: np.ndarray, order: np.ndarray, min_bytes: int, separator: int) -> np.ndarray:
    """Per place in the suffix order whether it shares fewer than ``min_bytes`` bytes with the one
    before.

    Common prefixes are found by increasing length. All bounds of length 0 are where the first
    byte changes. A bound of length l between two suffixes, put behind any byte that precedes
    both sides of it, is a bound of length l + 1 unless a shorter one is there already. The place
    of that bound comes from counting the byte in the transform up to the bound (backward
    extension). The expansion stops at ``min_bytes``; what is then no bound shares that much.
    """
    n = len(data)
    transform = data[order - 1]
    counts = np.bincount(data, minlength=256)
    symbols = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[symbols]
    bound = np.zeros(n + 1, bool)
    bound[first] = True
    bound[n] = True
    kept = symbols != separator
    symbols, first = symbols[kept], first[kept]
    if len(symbols) * (n + 1) <= _COUNT_ENTRIES:
        before = np.zeros((len(symbols), n + 1), np.int32)
        for i, c in enumerate(symbols):
            np.cumsum(transform == c, out=before[i, 1:])
        before += first[:, None].astype(np.int32)
        extended = lambda bounds: before[:, bounds]
    else:
        places = [np.flatnonzero(transform == c) for c in symbols]
        extended = lambda bounds: np.stack([np.searchsorted(p, bounds) + f for p, f in zip(places, first)])
    bounds = np.flatnonzero(bound)
    for _ in range(1, min_bytes):
        if not len(bounds) or not len(symbols):
            break
        reached = extended(bounds).ravel()
        reached = reached[~bound[reached]]
        if len(reached) > 1:
            fresh = np.ones(len(reached), bool)
            fresh[1:] = reached[1:] != reached[:-1]
            reached = reached[fresh]
        bound[reached] = True
        bounds = reached
    return bound[:n]


def repeated_windows(
    parts: list[bytes], windows: np.ndarray, copied: np.ndarray, min_bytes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of some segments by content.

    Segment i has ``windows[i]`` windows, from its first byte on; ``copied`` ones also occur
    elsewhere. Returns per window its segment, its place in it, and its class: equal windows have
    the same class, negative for a window that occurs only once.
    """
    data = np.frombuffer(_SEPARATOR.join(parts) + _SEPARATOR, np.uint8)
    lengths = np.array([len(p) + 1 for p in parts])
    offsets = np.cumsum(lengths) - lengths
    order = suffix_order(data, min_bytes)
    bound = common_prefix_bounds(data, order, min_bytes, _SEPARATOR[0])
    number = np.cumsum(bound)
    part = np.searchsorted(offsets, order, "right") - 1
    place = order - offsets[part]
    valid = place < windows[part]
    part, place, number = part[valid], place[valid], number[valid]
    weight = np.bincount(number, 1 + copied[part].astype(np.int64))
    return part, place, np.where(weight[number] > 1, number, -number - 1)


# --- the operator --------------------------------------------------------------------------


def _scan(min_bytes: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            for number, first, n, gram, digest, again in segments(texts, min_bytes):
                columns = [keys[number], first.astype(np.int32), n.astype(np.int32), gram, digest, again]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["_key", "first", "n", "gram", "digest", "again"]
                )

    return scan


def _cut(min_bytes: int) -> Callable:
    """The bytes of the segments wanted of each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("_key", "first", "n", "gram", "part", "copied", "hot", "bytes")}
            for key, text, wanted in zip(
                batch["_key"].to_pylist(), batch["text"], batch["wanted"].to_pylist()
            ):
                data = text.as_buffer().to_pybytes()
                for w in wanted:
                    rows["_key"].append(key)
                    rows["bytes"].append(data[w["first"] : w["first"] + w["n"] + min_bytes - 1])
                    for c in ("first", "n", "gram", "part", "copied", "hot"):
                        rows[c].append(w[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[c], t) for c, t in _CUT_TYPES.items()], names=list(_CUT_TYPES)
            )

    return cut


_CUT_TYPES = {
    "_key": pa.int64(), "first": pa.int32(), "n": pa.int32(), "gram": pa.int64(), "part": pa.int32(),
    "copied": pa.bool_(), "hot": pa.bool_(), "bytes": pa.binary(),
}
_CUT_SCHEMA = "_key bigint, first int, n int, gram bigint, part int, copied boolean, hot boolean, bytes binary"


_SETTLED_TYPES = {
    "_key": pa.int64(), "first": pa.int32(), "n": pa.int32(), "part": pa.int32(), "core": pa.binary(),
    "windows": pa.list_(pa.int32()), "found": pa.list_(pa.bool_()), "bytes": pa.binary(),
}
_SETTLED_SCHEMA = (
    "_key bigint, first int, n int, part int, core binary, windows array<int>, found array<boolean>, bytes binary"
)


def _settle(min_bytes: int) -> Callable:
    """Runs of repeated windows of the segments of a partition, sorted by hash and part.

    The windows of a hash with several parts may have partners in other parts. One window of each
    class comes out as well, in blocks; see ``_blocks``.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                group = (row["gram"], row["part"])
                if size >= _SORTED_AT_ONCE and group != last:
                    yield from _settled(rows, min_bytes)
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row["bytes"]) + 1, group
        if rows:
            yield from _settled(rows, min_bytes)

    return settle


def _settled(rows: list[dict], min_bytes: int) -> Iterator[pa.RecordBatch]:
    windows, firsts = np.array([r["n"] for r in rows]), np.array([r["first"] for r in rows])
    keys = np.array([r["_key"] for r in rows])
    copied, hot = np.array([r["copied"] for r in rows]), np.array([r["hot"] for r in rows])
    part, place, number = repeated_windows([r["bytes"] for r in rows], windows, copied, min_bytes)
    # Segments that occur more than once are repeated as a whole and known to be so.
    own = (number >= 0) & ~copied[part]
    by_place = np.lexsort((place[own], part[own]))
    p, at = part[own][by_place], place[own][by_place]
    if len(p):
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (at[1:] != at[:-1] + 1)
        starts = np.flatnonzero(new)
        n = np.diff(np.append(starts, len(p)))
        columns = {"_key": keys[p[starts]], "first": firsts[p[starts]] + at[starts], "n": n}
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[c], t) if c in columns else pa.nulls(len(n), t) for c, t in _SETTLED_TYPES.items()],
            names=list(_SETTLED_TYPES),
        )
    if hot.any():
        chosen = np.flatnonzero(hot[part])
        _, one = np.unique(number[chosen], return_index=True)
        chosen = chosen[one]
        chosen = chosen[np.lexsort((place[chosen], part[chosen]))]
        blocks = _blocks(rows, part[chosen], place[chosen], number[chosen] >= 0, min_bytes)
        yield pa.RecordBatch.from_pylist(list(blocks), schema=pa.schema(list(_SETTLED_TYPES.items())))


def _blocks(
    rows: list[dict], part: np.ndarray, place: np.ndarray, found: np.ndarray, min_bytes: int
) -> Iterator[dict]:
    """Windows of segments, joined where the hash stands at nearly the same place in them.

    Windows with their hash at ``_BLOCK`` neighbouring places have all but ``_BLOCK - 1`` bytes in
    common, the core. Only windows of equal cores can be equal, so most are ruled out by one digest
    for the block. A row has the core's digest, the bytes of the block, and the windows in it with
    whether they are known to be repeated.
    """
    gram = _gram_of(min_bytes)
    for i in np.unique(part).tolist():
        row, mine = rows[i], np.flatnonzero(part == i)
        data = row["bytes"]
        hashes = gram_hashes(np.frombuffer(data, np.uint8), gram).view(np.int64)
        stands = np.flatnonzero(hashes == row["gram"])
        starts = place[mine]
        at = stands[np.searchsorted(stands, starts)]
        block = (at - starts) // _BLOCK
        new = np.ones(len(mine), bool)
        new[1:] = (block[1:] != block[:-1]) | (at[1:] != at[:-1])
        edges = [*np.flatnonzero(new).tolist(), len(mine)]
        for a, b in zip(edges, edges[1:]):
            first, last = int(starts[a]), int(starts[b - 1])
            core = int(at[a]) - int(block[a]) * _BLOCK
            shared = data[core : core + max(0, min_bytes - _BLOCK + 1)]
            yield {
                "_key": row["_key"],
                "first": row["first"] + first,
                "n": None,
                "part": row["part"],
                "core": xxhash.xxh3_128_digest(shared),
                "windows": (starts[a:b] - first).tolist(),
                "found": found[mine[a:b]].tolist(),
                "bytes": data[first : last + min_bytes],
            }


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, removed, n_spans = [], [], [], []
        for text, spans in zip(batch["text"], batch["spans"].to_pylist()):
            data = text.as_buffer().to_pybytes()
            parts, at, runs = [], 0, 0
            for span in spans or []:
                if span["first"] > at or not runs:
                    parts.append(data[at : span["first"]])
                    runs += 1
                at = max(at, span["last"])
            parts.append(data[at:])
            rest = b"".join(parts)
            kept.append(rest)
            sizes.append(len(data))
            removed.append(len(data) - len(rest))
            n_spans.append(runs)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(n_spans, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _across_parts(blocks: DataFrame, min_bytes: int) -> DataFrame:
    """Windows not known to be repeated that have an equal one in another part."""
    cores = blocks.groupBy("core").agg(F.min("part").alias("_low"), F.max("part").alias("_high"))
    shared = lookup(blocks, cores.where("_low != _high").select("core"), ["core"], "inner")
    place = F.col("place") + 1
    windows = shared.select(
        "_key", "first", "part", "bytes", F.inline(F.arrays_zip("windows", "found")).alias("place", "found")
    ).select(
        "_key",
        (F.col("first") + F.col("place")).alias("first"),
        "found",
        F.md5(F.substring("bytes", place, F.lit(min_bytes))).alias("digest"),
    )
    # Each part shows a window once, so two rows are two parts.
    twice = windows.groupBy("digest").agg(F.count("*").alias("_times")).where("_times > 1").select("digest")
    alone = windows.where("NOT found")
    return lookup(alone, twice, ["digest"], "inner").select("_key", "first", F.lit(1).alias("n"))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """The UTF-8 bytes of each text without those inside a string that occurs twice.

    Removed is each byte covered by a string of ``min_bytes`` bytes that also starts anywhere
    else, in the same text or another one; strings are judged on the input and end with their text.

    Returns id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (binary; a
    run may end inside a character). A row per row: a repeated row is a copy like any other. Null
    and short texts lose nothing. Rows are told apart by a 64-bit hash of id and text. Runs jobs
    when called.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    whole = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), text.alias("text")
    )
    found = stored(
        whole.select("_key", "text").mapInArrow(
            _scan(min_bytes), "_key bigint, first int, n int, gram bigint, digest bigint, again boolean"
        ),
        "segments",
    )
    times, differ = F.col("_times"), F.col("_low") != F.col("_high")
    met = (
        found.groupBy("gram")
        .agg(
            F.count("*").alias("_times"),
            F.min("digest").alias("_low"),
            F.max("digest").alias("_high"),
            F.max("again").alias("_again"),
        )
        .where((times > 1) | F.col("_again"))
        .select("gram", (differ | (times == 1)).alias("_differ"))
    )
    hits = stored(lookup(found.drop("again"), met, ["gram"], "inner"), "hits")

    # One segment for all equal ones; alone with its hash, it needs no comparison.
    whole_width = (F.col("first") + F.col("n") + (min_bytes - 1)).alias("last")
    distinct = (
        hits.where("_differ")
        .groupBy("gram", "digest")
        .agg(F.min(F.struct("_key", "first", "n")).alias("one"), F.count("*").alias("_copies"))
    )
    distinct = stored(distinct.select("gram", "digest", "one.*", (F.col("_copies") > 1).alias("copied")), "distinct")
    sizes = distinct.groupBy("gram").agg(F.sum(F.col("n") + min_bytes).alias("_bytes"))
    hot = sizes.where(F.col("_bytes") > _HOT_BYTES)
    placed = lookup(distinct, hot, ["gram"])
    n_parts = F.coalesce(F.ceil(F.col("_bytes") / _HOT_BYTES), F.lit(1))
    wanted = placed.select(
        "_key",
        F.struct(
            "first",
            "n",
            "gram",
            F.pmod(F.col("digest"), n_parts).cast("int").alias("part"),
            "copied",
            F.col("_bytes").isNotNull().alias("hot"),
        ).alias("w"),
    ).groupBy("_key").agg(F.collect_list("w").alias("wanted"))
    cut = whole.join(wanted, "_key").select("_key", "text", "wanted").mapInArrow(_cut(min_bytes), _CUT_SCHEMA)
    settled = stored(
        cut.repartition("gram", "part")
        .sortWithinPartitions("gram", "part")
        .mapInArrow(_settle(min_bytes), _SETTLED_SCHEMA),
        "settled",
    )
    near = settled.where("core IS NULL").select("_key", "first", "n")
    far = _across_parts(settled.where("core IS NOT NULL"), min_bytes)

    copies = distinct.where("copied").select("gram", "digest")
    equal = lookup(hits.where("_differ"), copies, ["gram", "digest"], "inner")
    spans = hits.where("NOT _differ").select("_key", "first", whole_width)
    for more in (equal, near, far):
        spans = spans.union(more.select("_key", "first", whole_width))
    per_text = spans.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"))
    return (
        whole.join(per_text, "_key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_remove, f"doc_id {_type(whole)}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )


def _type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()
