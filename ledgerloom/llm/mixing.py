"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACED_WORD, stored
from ledgerloom.operators.ids import running_sums
from ledgerloom.operators.joins import lookup

MAX_REPEATS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def cycled_weights(rank: Column, weights: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The weights in turn, for sources ranked from 0."""
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))


def source_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target``: the source's part of the total size, by ``weight``, at most ``max_repeats``
    times its own ``source_size``; what a source can't take is shared again by weight.

    A source is full at the time ``max_repeats * size / weight``. Sources in the order of these
    times: up to the first whose time is not reached, all are full, and the rest divide what
    remains by weight.
    """
    most = F.col("source_size") * max_repeats
    ordered = running_sums(
        sources,
        [most / F.col("weight"), "source_rank"],
        {"_full": most, "_spent": F.col("weight").cast("bigint")},
    )
    total = sources.agg(F.sum("source_size").cast("bigint")).scalar()
    all_weights = sources.agg(F.sum("weight").cast("bigint")).scalar()
    left, weights = total - F.col("_full"), all_weights - F.col("_spent")
    first_open = F.min_by(F.col("_level"), F.struct(most / F.col("weight"), "source_rank"))
    level = (
        ordered.withColumns({"_left": left, "_weights": weights})
        .where(F.col("_left") * F.col("weight") <= most * F.col("_weights"))
        .withColumn("_level", F.col("_left") / F.col("_weights"))
        .agg(first_open)
        .scalar()
    )
    return sources.withColumn("target", F.least(most.cast("double"), level * F.col("weight")))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """How often each document is taken into a mix as large as all documents together.

    The size of a document is its number of words. Sources in the order of code points, null
    last, weigh ``weights`` in turn. The documents of a source are shuffled by a hash of their id
    and queued ``max_repeats`` times over; the virtual finish time of a place in the queue is the
    number of the source's words up to it, divided by the weight. All places are sorted by finish
    time and cut where the words of the mix reach the total, which is where each source has got
    its target.

    Returns id, ``size``, ``source_size``, ``target`` (of its source) and ``taken`` (words, repeats
    counted), a row per input row. A null text has size 0; documents of size 0 are taken 0 words.
    Rows with equal id, source and size change places without a difference. No row: no result.
    Runs jobs when called.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).isNull().alias("_no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_source"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|" + seed))).alias("_turn"),
        word_count(F.col(text_col)).alias("size"),
    )
    # Stored, for ordering looks at its input twice.
    narrow = stored(narrow, "sizes")
    source = ["_no_source", "_source"]
    queue = [*source, "_turn", "doc_id", "size"]
    rows = running_sums(narrow, queue, {"_before": F.col("size"), "_row": F.lit(1)})
    sizes = rows.groupBy(*source).agg(F.sum("size").cast("bigint").alias("source_size"))
    ranked = running_sums(sizes, source, {"_earlier": F.col("source_size"), "source_rank": F.lit(1)})
    weighted = stored(ranked.withColumn("weight", cycled_weights(F.col("source_rank"), weights)), "sources")
    targets = source_targets(weighted, max_repeats)

    placed = lookup(rows, targets, source).withColumn("_before", F.col("_before") - F.col("_earlier"))
    placed = placed.drop("_turn", "_earlier", *source)
    round_end = F.col("_before") + F.col("size") + F.col("_round") * F.col("source_size")
    places = placed.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn(
        "_finish", round_end / F.col("weight")
    )
    merged = running_sums(
        places, ["_finish", "source_rank", "_round", "_row"], {"_mixed": F.col("size")}
    )
    total = rows.agg(F.sum("size")).scalar()
    taken = F.when(F.col("_mixed") + F.col("size") <= total, F.col("size")).otherwise(0)
    return (
        merged.groupBy("_row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(taken).cast("bigint").alias("taken"))
        .drop("_row")
    )


ORACLE = f"""
WITH d AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '') || '|{SEED}') AS turn
    FROM documents
),
s AS (
    SELECT source, source_size, source_rank, (source_rank % 3 + 1)::BIGINT AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size,
                 row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank
          FROM d GROUP BY source)
),
f AS (
    SELECT *, (SELECT sum(source_size) FROM s)::BIGINT
              - coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS left_over,
           sum(weight) OVER after AS weights
    FROM s
    WINDOW before AS (ORDER BY 3 * source_size / weight, source_rank
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           after AS (ORDER BY 3 * source_size / weight, source_rank
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
v AS (
    SELECT arg_min(left_over::DOUBLE / weights::DOUBLE, (3 * source_size / weight, source_rank)) AS level
    FROM f WHERE left_over * weight <= 3 * source_size * weights
),
t AS (SELECT s.*, least(3.0::DOUBLE * source_size, level * weight) AS target FROM s, v),
q AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.weight, t.source_rank,
           sum(d.size) OVER (PARTITION BY t.source_rank ORDER BY d.turn, d.doc_id, d.size
                             ROWS UNBOUNDED PRECEDING)::BIGINT AS upto,
           row_number() OVER (ORDER BY t.source_rank, d.turn, d.doc_id, d.size) AS place
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
m AS (
    SELECT *, sum(size) OVER (ORDER BY finish, source_rank, round, place ROWS UNBOUNDED PRECEDING) AS mixed
    FROM (SELECT q.*, r.round, (upto + r.round * source_size) / weight AS finish
          FROM q, (SELECT unnest([0, 1, 2]) AS round) r)
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size, any_value(source_size) AS source_size,
       any_value(target) AS target,
       sum(CASE WHEN mixed <= (SELECT sum(size) FROM d) THEN size ELSE 0 END)::BIGINT AS taken
FROM m GROUP BY place
"""
