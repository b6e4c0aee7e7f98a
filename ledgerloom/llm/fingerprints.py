"""Document fingerprints by one-permutation MinHash, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACED_WORD, let, row_key, stored
from ledgerloom.operators.ids import running_sums

SHINGLE_WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
KEPT_BITS = 8

# Bins an empty bin looks at in turn before all filled bins are ordered for it.
_PROBES = 12


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def _shingles(text: Column, words: int) -> Column:
    """Hashes of all runs of ``words`` words; a shorter text is one run, none has none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SPACED_WORD), F.lit(0))

    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - (words - 1), F.lit(1))
        each = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(w, i, words)))
        return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<bigint>"))

    return let(found, hashes)


def minhash(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as an array of ``BINS`` numbers of ``KEPT_BITS`` bits; empty without words.

    The leading bits of a shingle's hash name its bin, and each bin keeps its smallest hash. An
    empty bin borrows from the first filled one of the bins that hashing its own number again and
    again names. Of each smallest hash the low bits are kept.
    """

    def smallest(h: Column) -> Column:
        # Sorted hashes of one bin stand together.
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    def borrowed(first: Column, dense: Column, j: Column) -> Column:
        probes = [
            F.get(dense, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(_PROBES)
        ]
        ordered = F.array_min(
            F.transform(first, lambda x: F.struct(F.xxhash64(j, _bin(x), F.lit(-1)).alias("o"), x.alias("x")))
        )
        return F.coalesce(*probes, ordered.x)

    def filled(first: Column) -> Column:
        bins = F.transform(first, _bin)
        numbers = F.sequence(F.lit(0), F.lit(BINS - 1))
        dense = let(
            bins,
            lambda b: F.transform(numbers, lambda j: F.get(first, (F.array_position(b, j) - 1).cast("int"))),
        )
        kept = F.lit((1 << KEPT_BITS) - 1)
        return let(
            dense,
            lambda d: F.transform(
                d, lambda x, j: F.coalesce(x, borrowed(first, d, j)).bitwiseAND(kept).cast("smallint")
            ),
        )

    first = let(F.sort_array(_shingles(text, words)), smallest)
    none = F.array().cast("array<smallint>")
    return let(first, lambda f: F.when(F.size(f) > 0, filled(f)).otherwise(none))


def packed(bins: Column) -> Column:
    """The fingerprint as hex digits; an empty text for one without words."""
    digits = KEPT_BITS // 4
    marked = F.transform(bins, lambda x: F.lower(F.substring(F.hex(x + (1 << KEPT_BITS)), 2, digits)))
    return F.array_join(marked, "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints.

    Kept bits of different hashes are equal by chance once in ``2 ** KEPT_BITS`` times, which is
    taken off. Two fingerprints without words are alike, one of them is unlike any other.
    """
    chance = 1 / (1 << KEPT_BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    estimate = F.greatest(F.lit(0.0), (same / F.lit(BINS) - F.lit(chance)) / F.lit(1 - chance))
    empty_a, empty_b = F.size(a) == 0, F.size(b) == 0
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(estimate)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its own and the next document's fingerprint and an edited text.

    The next document is that with the next smaller id; after the last comes the first. In the
    edited text the last third of the code points, rounded down, is replaced by as many from the
    start of the next text, or all it has.

    Returns id, ``next_id``, ``text``, ``n_chars``, ``edited``, ``bins``, ``edited_bins`` and ``next_bins``. Rows
    with equal id and text count as one document; of rows with equal id the order is that of a
    hash, and rows without id come last. A null text is empty. Runs jobs when called.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(
        F.col(id_col).alias("doc_id"), row_key(F.col(id_col), text).alias("_key"), text.alias("text")
    )
    narrow = whole.select("doc_id", "_key", F.char_length("text").alias("n_chars")).distinct()
    narrow = stored(narrow, "lengths")  # ordering looks at its input twice
    ranked = stored(
        running_sums(narrow, [F.col("doc_id").desc_nulls_last(), "_key"], {"_rank": F.lit(1)}), "ranked"
    )
    n_docs = ranked.agg(F.count("*")).scalar()
    before = ranked.select(
        F.pmod(F.col("_rank") + 1, n_docs).alias("_rank"),
        F.col("_key").alias("_before"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("_asked"),
    )
    asked = ranked.select("_key", "_rank").join(before, "_rank").drop("_rank")

    # Both joins read the same exchange of the texts by key, if both need the same columns of it:
    # as long as next_id is asked for.
    heads = whole.join(asked, "_key").select(
        F.col("_before").alias("_key"),
        F.col("doc_id").alias("next_id"),
        F.left("text", F.col("_asked")).alias("_head"),
        minhash(F.col("text")).alias("next_bins"),
    )
    n, third = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    both = whole.join(heads, "_key").dropDuplicates(["_key"])
    both = both.select(
        "doc_id",
        "next_id",
        "text",
        n.alias("n_chars"),
        F.concat(F.left("text", n - third), "_head").alias("edited"),
        "next_bins",
    )
    return both.withColumns({"bins": minhash(F.col("text")), "edited_bins": minhash(F.col("edited"))})
