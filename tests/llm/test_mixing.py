"""Weighted fair mixing: targets, sums and repeats."""

import cases
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing


def targets(sizes, weights, cap=3):
    """Shares by weight, with what is over the cap shared again."""
    out, left, open_ = [0.0] * len(sizes), sum(sizes), set(range(len(sizes)))
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if level * weights[i] > cap * sizes[i]}
        if not full:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ -= full
    return out


@pytest.mark.parametrize("sizes", [[10, 400, 3, 900, 5, 1], [7], [5, 5, 5], [1, 1000], [0, 10, 0]])
def test_targets_and_taken(spark, sizes):
    rows = [(100 * s + k, " ".join(["w"] * (n // 5 + (k < n % 5))), f"s{s:02}") for s, n in enumerate(sizes) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).collect()
    expected = targets(sizes, [1 + i % 3 for i in range(len(sizes))])
    largest = max((n + 4) // 5 for n in sizes)
    assert len(got) == len(rows)
    for s, n in enumerate(sizes):
        own = [r for r in got if r.doc_id // 100 == s]
        assert all(r.source_size == n and r.target == pytest.approx(expected[s]) for r in own)
        assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in own if r.size)
        assert abs(sum(r.taken for r in own) - expected[s]) <= 2 * largest
    assert sum(sizes) - largest <= sum(r.taken for r in got) <= sum(sizes)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = sorted(map(str, got.collect()))
    assert len(rows) == docs.count()
    assert rows == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert got.where("doc_id = 3").first()["size"] == 0 and got.where("doc_id = 12").first()["size"] == 30_000
    # Null sources are one source, the last.
    sizes = docs.where("source IS NULL").agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert got.where("doc_id = 0").first().source_size == sizes


def test_empty_table(spark):
    assert mixing.mix(cases.empty(spark)).count() == 0
