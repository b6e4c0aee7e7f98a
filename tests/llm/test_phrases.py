"""Mined phrases against counts of all n-grams in a dictionary."""

import random
import re
from collections import Counter, defaultdict

import cases
import pytest

from ledgerloom.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_count, longest=5, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        frequent = {p: a for p, a in f.items() if a >= min_count}
        for p, a in frequent.items():
            if len(p) == 1:
                continue
            score, _, lr = min(
                (1000 * a * n // (f[p[:k]] * f[p[k:]]), k, (f[p[:k]], f[p[k:]])) for k in range(1, len(p))
            )
            inside = any(
                b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in frequent.items()
            )
            if not inside:
                found.append((score, a, " ".join(p), *lr))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def run(spark, docs, **more):
    df = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "lang string, text string").repartition(4)
    return sorted(map(tuple, P.collocations(df, **more).collect()))


def random_docs(seed, n=60):
    random.seed(seed)
    words = ["a", "B", "c", "été", "你", "x\x00y", "x", "x\x01", "d'e", "'"] + [f"rare{i}" for i in range(30)]
    weights = [9, 7, 5, 3, 3, 2, 2, 2, 1, 1] + [0.1] * 30
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", " ; ", "?!"]

    def text():
        parts = random.choices(words, weights, k=random.randint(0, 80))
        return "".join(p + random.choice(ends) for p in parts) + random.choice(["", "a b c d e f", "new york city hall"])

    docs = [(random.choice(["en", "de", None, "und", "x y"]), text()) for _ in range(n)]
    return docs + [("en", None), (None, ""), ("en", " \t\n"), docs[0], docs[0]]


@pytest.mark.parametrize("seed, min_count, longest", [(0, 3, 5), (1, 5, 5), (2, 2, 3), (3, 1, 2), (4, 12, 5)])
def test_random_texts(spark, seed, min_count, longest):
    docs = random_docs(seed)
    assert run(spark, docs, min_count=min_count, longest=longest) == brute(docs, min_count, longest)


def test_runs_over_batches_and_partitions(spark, conf):
    """Runs of a phrase that go on in other batches and partitions are summed."""
    conf({
        "spark.sql.execution.arrow.maxRecordsPerBatch": "3",
        "spark.sql.shuffle.partitions": "9",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    docs = random_docs(7)
    assert run(spark, docs, min_count=4) == brute(docs, 4)


def test_full_buckets_change_nothing(spark, monkeypatch):
    docs = random_docs(8)
    monkeypatch.setattr(P, "frequent_pairs", lambda docs, min_count: b"\xff" * 8192)
    assert run(spark, docs, min_count=4) == brute(docs, 4)


def test_rare_pairs_end_windows(spark):
    """Most windows of texts without repeated pairs are single words."""
    docs = [("en", " ".join(f"w{(i * k) % 997}" for k in range(200))) for i in range(1, 40)] + [("en", "in spite of " * 50)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    flags = P.frequent_pairs(df, 45)
    assert 1 <= sum(b.bit_count() for b in flags) < 40
    assert run(spark, df, min_count=45) == brute(docs, 45)


def test_top_of_a_language(spark):
    docs = random_docs(11)
    assert run(spark, docs, min_count=2, top=7) == brute(docs, 2, top=7)
    everything = {(r[0], r[2]) for r in run(spark, docs, min_count=2, top=None)}
    assert everything == {(r[0], r[2]) for r in brute(docs, 2, top=10**9)}


def test_ties_of_cuts_and_phrases(spark):
    """Equal scores take the shortest first part; equal phrases stand in byte order."""
    docs = [("en", "a b c. " * 10), ("de", "\U0001f600 r. \uffee r. " * 5)]
    got = run(spark, docs, min_count=5)
    assert got == brute(docs, 5) and [r[2] for r in got if r[0] == "de"] == ["\uffee r", "\U0001f600 r"]


def test_exact_beyond_64_bits(spark):
    """The score is exact where the products don't fit 64 bits."""
    from pyspark.sql import functions as F

    a, n, l, r = 3_000_000_000_001, 15_000_000_000_007, 3_100_000_000_003, 7_000_000_000_001
    whole = "decimal(17,0)"
    df = spark.range(1).select(
        (F.lit(1000).cast("decimal(4,0)") * F.lit(a).cast(whole) * F.lit(n).cast(whole)).alias("over"),
        (F.lit(l).cast("decimal(19,0)") * F.lit(r).cast("decimal(19,0)")).alias("under"),
    )
    assert df.select(F.expr("over div under")).first()[0] == 1000 * a * n // (l * r)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert run(spark, docs, min_count=3) == brute(rows, 3)
    assert run(spark, cases.empty(spark)) == []
    no_words = spark.createDataFrame([(None, "..."), ("en", None)], "lang string, text string")
    assert run(spark, no_words) == []


def test_other_names(spark):
    df = spark.createDataFrame([("en", "to be or " * 120, 1, "w")], "l string, t string, n int, w1 string")
    got = P.collocations(df, lang_col="l", text_col="t").collect()
    assert {r.phrase for r in got} == {r[2] for r in brute([("en", "to be or " * 120)], 100)}
