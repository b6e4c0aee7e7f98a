"""Benchmark decontamination by winnowing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import let, lower_ascii, row_key, stored
from ledgerloom.operators.joins import lookup

# Words are runs of ASCII letters and digits and of anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5

# A hash gives the high bits of a packed value and a place the low ones.
_PLACE_BITS = 26
_PLACES = 1 << _PLACE_BITS

# Bytes of a table of the benchmark side up to which it is sent to all executors.
BROADCAST_BYTES = 16 * 1024 * 1024


def words_of(text: Column) -> Column:
    """The lower-cased words of a text; none if it is null."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _upto(last: Column, first: Column | int = 1) -> Column:
    """The numbers from ``first`` to ``last``; none if there are none."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _gram(width: int) -> int:
    return min(width, GRAM)


def _grams(words: Column, gram: int) -> Column:
    """Per word the hash of the ``gram`` words from it on, packed with its place."""
    return F.transform(
        _upto(F.size(words) - (gram - 1)),
        lambda i: F.xxhash64(F.slice(words, i, gram))
        .bitwiseAND(F.lit(-_PLACES))
        .bitwiseOR(i.cast("bigint").bitwiseAND(F.lit(_PLACES - 1))),
    )


def _least(grams: Column, grams_each: int) -> Column:
    """Of each stretch of so many grams the least one, each once; a shorter text has none."""
    if grams_each == 1:
        return grams
    least = F.transform(
        _upto(F.size(grams) - (grams_each - 1)), lambda i: F.array_min(F.slice(grams, i, grams_each))
    )
    return F.array_distinct(least)


def fingerprints(words: Column, width: int) -> Column:
    """Per stretch of ``width`` words the smallest hash of its grams, as packed hash and place.

    Two texts that share ``width`` words in a row share the smallest hash of that stretch.
    ``words`` has to be computed already, for each gram looks it up.
    """
    gram = _gram(width)
    return let(_grams(words, gram), lambda g: _least(g, width - gram + 1))


def _prints(words: Column, widths: list[int]) -> Column:
    """(width, hash, place) of all fingerprints for all widths; grams of a size are hashed once."""

    def split(packed: Column, width: int) -> Column:
        return F.transform(
            packed,
            lambda v: F.struct(
                F.lit(width).alias("width"),
                v.bitwiseAND(F.lit(-_PLACES)).alias("hash"),
                v.bitwiseAND(F.lit(_PLACES - 1)).cast("int").alias("place"),
            ),
        )

    def of(gram: int) -> Column:
        same = [w for w in widths if _gram(w) == gram]
        return let(
            _grams(words, gram), lambda g: F.concat(*[split(_least(g, w - gram + 1), w) for w in same])
        )

    return F.concat(*[of(gram) for gram in sorted({_gram(w) for w in widths})])


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its rows were measured to be small."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (first, last)."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(spans),
        start,
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0), s.last - F.greatest(s.first - 1, acc.upto))).alias("n"),
            F.greatest(acc.upto, s.last).alias("upto"),
        ),
        lambda acc: acc.n,
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The words of each document that stand in a passage of a benchmark item.

    A passage is ``window`` words of an item in a row, or a whole item of fewer. Documents and
    items are winnowed: of each stretch of that many words the smallest gram hash is kept, so
    every shared passage shares one. Hashes that meet are extended to the stretches around them,
    and these are compared as texts, so the result is exact.

    Returns id, ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (as strings, sorted),
    ``contaminated`` and ``row_key``, a 128-bit hash of id and text. Rows with equal id and text count as one document and give one row; a null
    id is an id like any other. Null texts have no words, and items without words match nothing.
    An item without id hits words but is in no list. Runs jobs on the benchmark when called.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item_id"), words_of(F.col(item_text_col)).alias("words")
    )
    items = stored(items.where(F.size("words") > 0), "benchmark-words")
    width = F.least(F.lit(window), F.size("words"))
    # At most ``window`` numbers.
    widths = sorted(r[0] for r in items.select(width).distinct().collect()) or [window]

    windows = items.select(
        "item_id",
        F.explode(
            F.transform(
                _upto(F.size("words") - width + 1), lambda i: F.array_join(F.slice("words", i, width), " ")
            )
        ).alias("passage"),
    )
    grouped = windows.groupBy("passage").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    grouped = stored(grouped.withColumn("set_id", F.sha2(F.to_json("item_ids"), 256)), "passages")
    passages = _small(grouped.select("passage", "set_id"))
    sets = _small(stored(grouped.select("set_id", "item_ids").dropDuplicates(["set_id"]), "item-sets"))
    of_items = [
        items.where(width == w).select(F.inline(_prints(F.col("words"), [w])).alias("width", "hash", "place"))
        for w in widths
    ]
    known = of_items[0]
    for more in of_items[1:]:
        known = known.union(more)
    # A print of width 0 stands for the document itself and carries its number of words.
    itself = known.sparkSession.range(1).select(F.lit(0).alias("width"), F.lit(0).cast("bigint").alias("hash"))
    known = _small(stored(known.select("width", "hash").distinct().union(itself), "benchmark-prints"))

    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(F.col(id_col), F.col(text_col)).alias("_key"),
        F.col(text_col).alias("text"),
    )
    own = lambda w: F.array(
        F.struct(F.lit(0).alias("width"), F.lit(0).cast("bigint").alias("hash"), F.size(w).alias("place"))
    )
    prints = keyed.select(
        "doc_id",
        "_key",
        F.inline(let(words_of(F.col("text")), lambda w: F.concat(own(w), _prints(w, widths)))).alias(
            "width", "hash", "place"
        ),
    )
    met = prints.join(known, ["width", "hash"], "left_semi")
    is_own = F.col("width") == 0
    narrow = met.groupBy("_key", "doc_id").agg(
        F.max(F.when(is_own, F.col("place"))).alias("n_words"),
        F.collect_set(F.when(~is_own, F.struct("width", "place"))).alias("hits"),
    )
    # A row per document without its text; only texts with hits are split again.
    narrow = stored(narrow, "document-hits")
    hits = _small(narrow.where(F.size("hits") > 0).select("_key", "hits"))

    def stretches(words: Column, hit: Column) -> Column:
        n, gram = F.size(words), F.least(F.lit(GRAM), hit.width)
        # A place is known up to multiples of 2 ** 26 words.
        places = F.when(hit.place <= n, F.sequence(hit.place, n, F.lit(_PLACES)))
        around = F.transform(
            places,
            lambda p: _upto(F.least(p, n - hit.width + 1), F.greatest(F.lit(1), p - (hit.width - gram))),
        )
        return F.transform(
            F.flatten(around), lambda i: F.struct(i.alias("first"), (i + hit.width - 1).alias("last"))
        )

    def candidates(words: Column) -> Column:
        spans = F.array_distinct(F.flatten(F.transform("hits", lambda h: stretches(words, h))))
        passage = lambda s: F.array_join(F.slice(words, s.first, s.last - s.first + 1), " ")
        return F.transform(
            spans, lambda s: F.struct(s.first.alias("first"), s.last.alias("last"), passage(s).alias("passage"))
        )

    found = lookup(keyed.drop("doc_id"), hits, ["_key"], "inner").select(
        "_key", F.explode(let(words_of(F.col("text")), candidates)).alias("s")
    )
    marked = lookup(found.select("_key", "s.*"), passages, ["passage"], "inner")
    per_doc = marked.groupBy("_key").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"), F.collect_set("set_id").alias("set_ids")
    )
    listed = lookup(per_doc.select("_key", "spans", F.explode("set_ids").alias("set_id")), sets, ["set_id"], "inner")
    in_items = listed.groupBy("_key").agg(
        F.first("spans").alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("_item_ids"),
    )
    result = lookup(narrow.drop("hits"), in_items, ["_key"]).select(
        "*",
        F.coalesce("_spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
        F.coalesce("_item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
    n_hit = _covered(F.col("spans")).cast("bigint")
    return result.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        "item_ids",
        (F.size("spans") > 0).alias("contaminated"),
        F.col("_key").alias("row_key"),
    )


ORACLE = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
i AS (
    SELECT item_id::VARCHAR AS item_id, words, least(10, len(words)) AS width
    FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
          FROM benchmark)
    WHERE len(words) > 0
),
p AS (
    SELECT DISTINCT item_id, width, array_to_string(words[a : a + width - 1], ' ') AS passage
    FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS a FROM i)
),
w AS (
    SELECT doc_id, a, width, array_to_string(words[a : a + width - 1], ' ') AS passage
    FROM (SELECT d.*, width, unnest(range(1, len(words) - width + 2)) AS a
          FROM d, (SELECT DISTINCT width FROM p) WHERE len(words) >= width)
),
m AS (SELECT w.doc_id, w.a, w.width, p.item_id FROM w JOIN p USING (width, passage)),
h AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(a, a + width)) AS place FROM (SELECT DISTINCT doc_id, a, width FROM m))
    GROUP BY doc_id
),
g AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""
