"""Fingerprints: edited texts, equal texts, and likeness against the true one."""

import hashlib
import re

import cases
import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints as P
from ledgerloom.llm.queries import op6_fingerprints


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def test_query(spark):
    texts = {i: t or "" for i, t in cases.texts_of().items()}
    order = sorted(texts, reverse=True)
    rows = op6_fingerprints(spark, cases.SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    errors = []
    for r in rows:
        own, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) == P.BINS * P.KEPT_BITS // 4
        errors += [r.near_edited - jaccard(own, edited), r.near_next - jaccard(own, after)]
    assert np.abs(errors).max() < 0.2 and np.std(errors) < 0.05 and abs(np.mean(errors)) < 0.02
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def test_few_shingles(spark):
    """Empty bins are filled alike, so short texts keep their likeness on average."""
    rows = []
    for k in range(300):
        common = [f"c{k}_{i}" for i in range(12)]
        rows.append((" ".join(common + [f"a{k}_{i}" for i in range(6)]), " ".join(common + [f"b{k}_{i}" for i in range(6)])))
    df = spark.createDataFrame(rows, "a string, b string")
    likeness = P.likeness(P.minhash(F.col("a")), P.minhash(F.col("b")))
    got = df.select(likeness.alias("x")).agg(F.avg("x")).first()[0]
    assert abs(got - np.mean([jaccard(a, b) for a, b in rows])) < 0.02


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    got = P.with_next(docs).collect()
    pairs = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert len(got) == len(pairs)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert of[3].bins == of[4].bins == of[5].bins == [] and len(of[12].bins) == P.BINS
    assert of[0].bins == of[1].bins and of[0].edited.startswith("one two") and len(of[7].bins) == P.BINS
    last = [r for r in got if r.doc_id is None]
    assert len(last) == 2 and of[0].next_id is None and sorted(str(r.next_id) for r in last) == ["15", "None"]


def test_one_and_no_row(spark):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")
    assert P.with_next(one).first().edited == "abcdab"
    assert P.with_next(cases.empty(spark)).count() == 0


def test_native_plan(spark):
    text = P.with_next(cases.awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
