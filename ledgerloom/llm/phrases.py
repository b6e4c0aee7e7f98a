"""Phrases whose words go together, mined from count streams in prefix and suffix order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import ship_package, stored
from ledgerloom.operators.joins import lookup

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"

# Buckets in which pairs and triples of words are counted to cut windows short: one for so many bytes
# of text, within these bounds. Full buckets cut less; the result is the same.
BYTES_PER_BUCKET = 64
MOST_BUCKETS = 1 << 25
_PAGE = 1 << 16

# Words, and different words, a task holds of all languages before it counts them.
_HELD_WORDS = 1 << 20

# Buckets of the ranking inside a language.
_RANK_BUCKETS = 64

# Ends of a piece become line feeds.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class _Words:
    """Words of one language as numbers from 1, in the order of the texts, 0 between pieces."""

    def __init__(self, lang: str):
        self.numbers: dict[bytes, int] = {}
        self.seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.line: list[int] = [0]

    def add(self, text: str | None) -> int:
        numbers, line = self.numbers, self.line
        before = len(line)
        for piece in (text or "").encode("utf-8", "surrogatepass").lower().translate(_ENDS).split(b"\n"):
            if words := piece.split():
                line += [numbers.setdefault(w, len(numbers) + 1) for w in words]
                line.append(0)
        return len(line) - before

    def buckets(self, line: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each place the buckets of its word and the next one, and of the next two; -1 where the
        piece ends before."""
        hashes = np.zeros(len(self.numbers) + 1, dtype="u8")
        for i, word in enumerate(self.numbers, 1):
            hashes[i] = xxhash.xxh64_intdigest(word, self.seed)
        own = hashes[line]
        shift = np.uint64(64 - n.bit_length() + 1)

        def mixed(first: np.ndarray, words_on: int) -> np.ndarray:
            after = np.append(own[words_on:], np.zeros(words_on, "u8"))
            return (first ^ (after * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)

        pair = (line > 0) & (np.append(line[1:], 0) > 0)
        two = mixed(own, 1)
        three = mixed(two ^ (two >> np.uint64(29)), 2)
        places = [(m >> shift).astype("i8") for m in (two, three)]
        return np.where(pair, places[0], -1), np.where(pair & np.append(pair[1:], False), places[1], -1)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Words]]:
    """The words of a task by language, a bounded number of them at a time."""
    held: dict[str, _Words] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            size += held.setdefault(lang, _Words(lang)).add(text)
            if size >= _HELD_WORDS:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _count_type(enough: int) -> str:
    """A type that holds the sum of two counts."""
    return "u1" if enough < 128 else "u4"


def _pair_counts(batches: Iterator[pa.RecordBatch], n: int, enough: int) -> Iterator[pa.RecordBatch]:
    """How often pairs and triples of words fall into each bucket, up to ``enough``, by pages."""
    counts = np.zeros(n, dtype=_count_type(enough))
    for _, words in _by_language(batches):
        for buckets in words.buckets(np.asarray(words.line), n):
            found, times = np.unique(buckets, return_counts=True)
            times, found = times[found >= 0], found[found >= 0]
            counts[found] = np.minimum(counts[found] + times, enough)
    pages = counts.reshape(-1, _PAGE)
    for page in np.flatnonzero(pages.any(axis=1)).tolist():
        packed = zlib.compress(pages[page].tobytes(), 1)
        yield pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int32()), "counts": pa.array([packed], pa.binary())})


def _frequent_pages(batches: Iterator[pd.DataFrame], enough: int) -> Iterator[pd.DataFrame]:
    """Of each page, which buckets reach ``enough`` over all tasks."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for page, packed in zip(batch["page"], batch["counts"], strict=True):
            counts = np.frombuffer(zlib.decompress(packed), dtype=_count_type(enough))
            before = total.get(page)
            total[page] = counts if before is None else np.minimum(before + counts, enough)
    rows = [(p, np.packbits(c >= enough, bitorder="little").tobytes()) for p, c in total.items()]
    yield pd.DataFrame(rows, columns=["page", "flags"])


def frequent_pairs(docs: DataFrame, min_count: int) -> bytes:
    """A bit per bucket of word pairs and triples, set if these together occur often enough.

    At most ``MOST_BUCKETS`` bits. All that occur ``min_count`` times have their bits set.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(_PAGE, min(MOST_BUCKETS, 1 << (size // BYTES_PER_BUCKET).bit_length()))
    counted = docs.mapInArrow(lambda b: _pair_counts(b, n, min_count), "page int, counts binary")
    pages = counted.repartition("page").mapInPandas(lambda b: _frequent_pages(b, min_count), "page int, flags binary")
    flags = bytearray(n // 8)
    for row in pages.collect():
        flags[row.page * _PAGE // 8 : (row.page + 1) * _PAGE // 8] = row.flags
    return bytes(flags)


def _windows(batches: Iterator[pa.RecordBatch], flags: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Different windows with their counts: from each word on up to ``longest`` words, ending where
    the piece ends or a pair or triple is too rare to be part of a phrase."""
    for lang, words in _by_language(batches):
        line = np.asarray(words.line + [0] * longest)
        pairs, triples = (
            (b >= 0) & ((flags[b >> 3] >> (b & 7).astype("u1")) & 1).astype(bool)
            for b in words.buckets(line, len(flags) * 8)
        )
        window = np.zeros((longest, len(line)), dtype="i4")
        window[0], goes_on = line, pairs
        for k in range(1, longest):
            window[k, :-k] = np.where(goes_on[:-k], line[k:], 0)
            # The next word has to be frequent behind the last two.
            goes_on = goes_on & np.append(triples[k - 1 :], np.zeros(k - 1, bool))
            goes_on &= np.append(pairs[k:], np.zeros(k, bool))
        alone = np.bincount(line[(line > 0) & (window[1] == 0)], minlength=1) if longest > 1 else np.bincount(line)
        alone[0] = 0
        single = np.zeros((longest, np.count_nonzero(alone)), dtype="i4")
        single[0] = np.flatnonzero(alone)
        window = window[:, window[1:].any(axis=0)]
        window = window[:, np.lexsort(window[::-1])]
        new = np.flatnonzero(np.append(True, (window[:, 1:] != window[:, :-1]).any(axis=0))[: window.shape[1]])
        times = np.append(np.diff(np.append(new, window.shape[1])), alone[single[0]]).astype("i8")
        window = np.concatenate([window[:, new], single], axis=1)
        vocabulary = pa.array([w.decode("utf-8", "surrogatepass") for w in words.numbers], pa.string())
        for at in range(0, len(times), 100_000):
            part = window[:, at : at + 100_000]
            columns = [vocabulary.take(pa.array(w - 1, mask=w == 0)) for w in part]
            size = part.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), *columns, pa.array(times[at : at + size])],
                names=["lang", *_names(longest), "n"],
            )


def _names(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def _prefix_counts(batches: Iterator[pa.RecordBatch], longest: int, min_count: int) -> Iterator[pa.RecordBatch]:
    """Counts of all phrases that windows in prefix order begin with.

    Windows with the same first words stand together, so a phrase's count is a sum over a run. The
    first and last run of a batch may go on in its neighbours and are given whatever they sum to;
    of the others only those that are frequent.
    """
    names = ["lang", *_names(longest)]
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        times = batch.column("n").to_numpy()
        new = np.zeros(rows, dtype=bool)
        new[0] = True
        for depth, name in enumerate(names):
            column = batch.column(name)
            codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
            if not depth:
                continue
            first = np.flatnonzero(new)
            sums = np.add.reduceat(times, first)
            edge = np.zeros(len(first), dtype=bool)
            edge[[0, -1]] = True
            taken = (codes[first] >= 0) & (edge | (sums >= min_count))
            if taken.any():
                rows_of = pa.array(first[taken])
                none = pa.nulls(int(taken.sum()), pa.string())
                columns = [batch.column(c).take(rows_of) if i <= depth else none for i, c in enumerate(names)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sums[taken])], names=[*names, "f"])


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int | None = TOP,
) -> DataFrame:
    """Phrases of two to ``longest`` words, by how much more often than by chance they occur.

    Texts (A-Z in lower case) are cut into pieces at ``.,;:!?`` and line ends, and these into words
    at blanks and tabs. In each language, n counts its words and f(phrase) the occurrences of a
    phrase in its pieces. For candidates, with a = f(phrase) >= ``min_count``, each cut into a first
    part (l) and a rest (r) scores floor(1000 * a * n / (l * r)); the cut with the lowest score
    counts, of equal ones that with the shortest first part. A candidate inside a longer one that
    occurs as often is left out. The ``top`` of a language by score, count and words are returned
    (all, unranked, if it is None).

    The windows of up to ``longest`` words from each word on are a count stream. Sorted in prefix
    order, it gives the counts of all phrases in one pass over runs, and the frequent ones are kept
    as a stored count stream. Sort-merge joins of this stream in the order of first parts, and in the
    order of rests, give l, r and the counts of extensions to either side; no table of counts is held
    in memory. Windows are cut short before pairs and triples of words that are too rare, known from
    counts in a bounded number of buckets.

    Columns: lang, rank, phrase, a, l, r, n, score. A null language is ``und``, together with a
    language of that name; null and empty texts have no words. Repeated rows count as often as they occur.
    Scores are exact while 1000 * a * n and l * r have at most 38 digits. Runs jobs when called.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(lang, F.col(text_col).alias("text"))
    names = ["lang", *_names(longest)]
    typed = ", ".join(f"{c} string" for c in names)

    sent = spark.sparkContext.broadcast(frequent_pairs(texts, min_count))
    windows = texts.mapInArrow(
        lambda b: _windows(b, np.frombuffer(sent.value, dtype="u1"), longest), f"{typed}, n bigint"
    )
    stream = stored(windows.groupBy(*names).agg(F.sum("n").alias("n")), "window-counts")
    in_order = stream.repartitionByRange(*names).sortWithinPartitions(*names)
    runs = in_order.mapInArrow(lambda b: _prefix_counts(b, longest, min_count), f"{typed}, f bigint")
    counts = runs.groupBy(*names).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    words = F.filter(F.array(*names[1:]), lambda w: w.isNotNull()).alias("words")
    frequent = stored(counts.select("lang", words, "f"), "phrase-counts")
    totals = stream.groupBy("lang").agg(F.sum("n").alias("n"))

    size = F.size("words")
    candidates = frequent.where(size >= 2)
    cuts = lookup(candidates, totals, ["lang"], "inner").select(
        "lang",
        "words",
        F.col("f").alias("a"),
        "n",
        F.inline(
            F.transform(
                F.sequence(F.lit(1), size - 1),
                lambda k: F.struct(
                    k.alias("k"), F.slice("words", 1, k).alias("first"), F.slice("words", k + 1, size - k).alias("rest")
                ),
            )
        ),
    )
    firsts = frequent.select("lang", F.col("words").alias("first"), F.col("f").alias("l")).hint("merge")
    rests = frequent.select("lang", F.col("words").alias("rest"), F.col("f").alias("r")).hint("merge")
    counted = lookup(lookup(cuts, firsts, ["lang", "first"], "inner"), rests, ["lang", "rest"], "inner")
    whole = "decimal(19,0)"
    scored = counted.withColumns(
        {
            "over": F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)"),
            "under": F.col("l").cast(whole) * F.col("r").cast(whole),
        }
    ).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.where(size >= 3).select(
        "lang",
        F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1))).alias("words"),
        "f",
    )
    extended = longer.groupBy("lang", "words").agg(F.max("f").alias("longer"))
    whole_only = lookup(best, extended.hint("merge"), ["lang", "words"]).where(
        F.coalesce(F.col("longer") < F.col("a"), F.lit(True))
    )
    listed = whole_only.select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        bucket = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_BUCKETS))
        near = F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order))
        listed = listed.withColumn("_bucket", bucket).withColumn("_near", near).where(F.col("_near") <= top)
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
        listed = listed.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    else:
        listed = listed.withColumn("rank", F.lit(None).cast("bigint"))
    return listed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang),
f AS (
    SELECT lang, words[i : i + m - 1] AS words, count(*)::BIGINT AS f
    FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i
          FROM p, (VALUES (1), (2), (3), (4), (5)) s(m) WHERE len(words) >= m)
    GROUP BY ALL HAVING count(*) >= 100
),
c AS (
    SELECT lang, words, f AS a, unnest(range(1, len(words))) AS k FROM f WHERE len(words) >= 2
),
s AS (
    SELECT c.lang, c.words, a, l.f AS l, r.f AS r, n,
           (1000 * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score, k
    FROM c JOIN n USING (lang)
    JOIN f l ON l.lang = c.lang AND l.words = c.words[1 : k]
    JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1 :]
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
e AS (
    SELECT lang, words[1 : len(words) - 1] AS words, f FROM f
    UNION ALL SELECT lang, words[2 :], f FROM f
),
x AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM b
    WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lang = b.lang AND e.words = b.words AND e.f >= b.a)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM x)
WHERE rank <= 2000
"""
