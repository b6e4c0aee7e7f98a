"""Removal of lines that repeat across documents, with two Bloom filters before exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package, stored
from ledgerloom.operators.joins import lookup

SHORTEST = 10

# Bits of a filter per line of the corpus, and the size that a filter never passes. A fuller filter
# only makes more lines suspects; what repeats is confirmed in any case.
BITS_PER_LINE = 16
FILTER_BYTES = 128 * 1024 * 1024

# A filter is put together in pages of so many bits.
_PAGE_BITS = 1 << 16

# Different lines a task holds before it hands on what it has seen.
_HELD = 1 << 20


def line_count(text: Column) -> Column:
    """Lines of a text; a null or empty text has one."""
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def line_digests(text: str | None, shortest: int) -> tuple[list[int], list[bytes]]:
    """Numbers of the lines whose key is long enough, and the 128-bit digests of their keys."""
    numbers, digests = [], []
    for number, line in enumerate((text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")):
        key = line.strip()
        if len(key) >= shortest and (
            len(key) >= 4 * shortest or len(key.decode("utf-8", "surrogatepass")) >= shortest
        ):
            numbers.append(number)
            digests.append(xxhash.xxh3_128_digest(key))
    return numbers, digests


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def filter_bits(lines: int) -> int:
    """Bits of a filter for so many lines: a power of two between a page and the bound."""
    wanted = max(_PAGE_BITS, lines * BITS_PER_LINE)
    return min(1 << (wanted - 1).bit_length(), FILTER_BYTES * 8)


def _paged(digests: np.ndarray, bits: int) -> dict[int, bytes]:
    """The filter bits of digests, two for each, as places inside the pages they fall on."""
    places = np.unique(digests.astype("<u8").ravel() & np.uint64(bits - 1))
    pages, first = np.unique(places // np.uint64(_PAGE_BITS), return_index=True)
    cuts = np.split((places % np.uint64(_PAGE_BITS)).astype("<u2"), first[1:])
    return {int(p): c.tobytes() for p, c in zip(pages, cuts, strict=True)} if len(places) else {}


def _once_and_twice(batches: Iterator[pd.DataFrame], bits: int, shortest: int) -> Iterator[pd.DataFrame]:
    """What the lines of a task put into both filters: each line once, repeated ones twice."""
    held: list[bytes] = []

    def handed_on() -> pd.DataFrame:
        halves = _halves(held)
        halves = halves[np.lexsort(halves.T)]
        again = (halves[1:] == halves[:-1]).all(axis=1)
        once, twice = _paged(halves, bits), _paged(halves[1:][again], bits)
        held.clear()
        rows = [(page, places, twice.get(page, b"")) for page, places in once.items()]
        return pd.DataFrame(rows, columns=["page", "once", "twice"])

    for batch in batches:
        for text in batch["text"]:
            held += dict.fromkeys(line_digests(text, shortest)[1])
            if len(held) >= _HELD:
                yield handed_on()
    if held:
        yield handed_on()


def _bitmap(places: bytes) -> np.ndarray:
    flags = np.zeros(_PAGE_BITS, dtype=bool)
    flags[np.frombuffer(places, dtype="<u2")] = True
    return np.packbits(flags, bitorder="little")


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The twice-seen filter by pages: what a task saw twice, and what two tasks saw once."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for page, o, t in zip(batch["page"], batch["once"], batch["twice"], strict=True):
            if page not in once:
                once[page], twice[page] = np.zeros((2, _PAGE_BITS // 8), dtype=np.uint8)
            seen = _bitmap(o)
            twice[page] |= (once[page] & seen) | _bitmap(t)
            once[page] |= seen
    rows = [(page, bitmap.tobytes()) for page, bitmap in twice.items() if bitmap.any()]
    yield pd.DataFrame(rows, columns=["page", "twice"])


def twice_seen(texts: DataFrame, shortest: int) -> bytearray:
    """The filter of lines that may be in two or more of the rows, at most ``FILTER_BYTES`` long."""
    lines = texts.agg(F.sum(line_count(F.col("text")))).first()[0] or 0
    bits = filter_bits(lines)
    seen = texts.select("text").mapInPandas(
        lambda batches: _once_and_twice(batches, bits, shortest), "page int, once binary, twice binary"
    )
    merged = seen.repartition("page").mapInPandas(_merged, "page int, twice binary")
    found = bytearray(bits // 8)
    for row in merged.collect():
        at = row.page * (_PAGE_BITS // 8)
        found[at : at + _PAGE_BITS // 8] = row.twice
    return found


def _suspects(batches: Iterator[pa.RecordBatch], twice: np.ndarray, shortest: int) -> Iterator[pa.RecordBatch]:
    """The lines whose bits are set in the filter, with the row and the digest."""
    mask = np.uint64(len(twice) * 8 - 1)
    for batch in batches:
        numbers, digests, sizes = [], [], []
        for text in batch.column("text").to_pylist():
            n, d = line_digests(text, shortest)
            numbers += n
            digests += d
            sizes.append(len(n))
        halves = _halves(digests)
        places = halves.astype("<u8") & mask
        bit = (twice[(places >> np.uint64(3)).astype("i8")] >> (places & np.uint64(7)).astype("u1")) & 1
        hit = np.flatnonzero(bit.all(axis=1))
        row = np.repeat(np.arange(len(sizes)), sizes)[hit]
        columns = [batch.column(c).take(pa.array(row)) for c in ("k1", "k2", "id")]
        columns += [pa.array(halves[hit, 0]), pa.array(halves[hit, 1])]
        columns.append(pa.array(np.asarray(numbers, dtype="i4")[hit]))
        yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "id", "d1", "d2", "line"])


def _without(text: pd.Series, lines: pd.Series) -> pd.Series:
    def kept(whole, dropped):
        if whole is None or dropped is None:
            return None
        gone = set(dropped.tolist())
        return "\n".join(line for i, line in enumerate(whole.split("\n")) if i not in gone)

    return pd.Series([kept(w, d) for w, d in zip(text, lines, strict=True)], dtype=object)


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """Texts without the lines that a document with a smaller id holds as well.

    The key of a line is the line without ASCII white space at both ends, A-Z in lower case. A key
    of at least ``shortest`` code points that is in two or more documents stays in the document with
    the smallest id, with all its lines there, and goes from the others.

    Every task puts its lines into two Bloom filters, one of lines seen and one of lines seen
    again; merging them keeps in the second what two tasks saw. Only lines that the second filter
    has are suspects and shuffled, as 128-bit digests, to find those in several documents and the
    first of these. The filter grows with the number of lines up to ``FILTER_BYTES``; beyond that
    more lines are suspects and the result is the same.

    A row per row: ``doc_id``, ``text`` as it was, ``n_lines``, ``n_dropped`` and ``kept``, the
    lines left joined by line feeds. Null and empty texts are one empty line, and ``kept`` is empty.
    Rows with the same id are one document, and so are all rows without id, which come after the
    others. Runs jobs when it is called.
    """
    spark = docs.sparkSession
    ship_package(spark)
    ids, texts = F.col(id_col).alias("id"), F.col(text_col).alias("text")
    # A hash of id and text in two seeds: 128 bits name a row.
    key = [F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias(k) for seed, k in ((1, "k1"), (2, "k2"))]
    rows = docs.select(ids, texts, *key)
    sent = spark.sparkContext.broadcast(bytes(twice_seen(rows, shortest)))
    id_type = rows.schema["id"].dataType.simpleString()
    suspects = stored(
        rows.mapInArrow(
            lambda batches: _suspects(batches, np.frombuffer(sent.value, dtype=np.uint8), shortest),
            f"k1 bigint, k2 bigint, id {id_type}, d1 bigint, d2 bigint, line int",
        ),
        "line-suspects",
    )
    order = F.struct(F.col("id").isNull(), F.col("id"))
    repeated = suspects.groupBy("d1", "d2").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    repeated = repeated.where(~F.col("first").eqNullSafe(F.col("last"))).select("d1", "d2", "first")
    later = lookup(suspects, repeated, ["d1", "d2"], "inner").where(~order.eqNullSafe(F.col("first")))
    dropped = later.groupBy("k1", "k2").agg(F.collect_set("line").alias("dropped"))
    marked = lookup(rows, dropped, ["k1", "k2"])
    some = F.col("dropped").isNotNull()
    rest = F.pandas_udf(_without, "string")(F.when(some, F.col("text")), F.col("dropped"))
    return marked.select(
        F.col("id").alias("doc_id"),
        "text",
        line_count(F.col("text")).alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(some, rest).otherwise(F.coalesce("text", F.lit(""))).alias("kept"),
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
    SELECT doc_id, place, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM t)
),
r AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
k AS (
    SELECT doc_id, place, line, r.key IS NULL OR l.doc_id = r.first AS stays
    FROM l LEFT JOIN r ON l.key = r.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) - count(*) FILTER (stays))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""
