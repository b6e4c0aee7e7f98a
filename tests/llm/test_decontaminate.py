"""Winnowed decontamination against windows compared one by one."""

import random
import re

import cases
import pytest

from ledgerloom.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(D.WORD, (text or "").translate(LOWER))


def brute(docs, items, window=10):
    passages = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            passages.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in passages}:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in passages:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in passages[p] if x is not None}
        out[doc, text] = (len(w), len(hit), tuple(sorted(found)), bool(hit))
    return out


def run(spark, docs, items, window=10):
    items = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.contamination(docs, items, window=window).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {(r.doc_id, texts[r.doc_id]): (r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in rows}
    assert len(got) == len(rows) and all(r.n_items == len(r.item_ids) for r in rows)
    return got


@pytest.mark.parametrize("window, broadcast", [(10, True), (10, False), (4, True)])
def test_random_texts(spark, monkeypatch, window, broadcast):
    """Few different words, so passages overlap, repeat and are in many items; short items too."""
    if not broadcast:
        monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    random.seed(window)
    draw = lambda n: " ".join(random.choice(["a", "B", "c", "\u00e9"]) for _ in range(n))
    items = [(i, draw(random.choice([12, 15, 20, 9, 7]))) for i in range(30)] + [(None, draw(11)), (40, None), (41, "!")]
    docs = [(i, draw(random.randint(0, 120))) for i in range(60)]
    docs += [(100, items[0][1] + " . " + items[3][1].upper()), (101, "x " * 50 + items[5][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert run(spark, df, items, window) == brute(docs, items, window)


def test_short_items(spark):
    """Items of one to nine words are windows of their own."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 13)]
    docs = [(n, f"x {text} y") for n, text in items] + [(50, "i9w0 i9w1 i9w2 i9w3 i9w4 i9w5 i9w6 i9w7")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = run(spark, df, items)
    assert got == brute(docs, items) and got[50, docs[-1][1]][1] == 0


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    items = [(1, "one two three four five six seven eight nine ten"), (2, "w100 " + " ".join(f"w{i}" for i in range(101, 115)))]
    rows = D.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    pairs = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(rows) == len(pairs)
    expected = sorted(brute(pairs, items).values())
    assert sorted((r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in rows) == expected


def test_places_beyond_the_packed_bits(spark, monkeypatch):
    monkeypatch.setattr(D, "_PLACE_BITS", 3)
    monkeypatch.setattr(D, "_PLACES", 8)
    items = [(1, " ".join(f"p{i}" for i in range(12)))]
    docs = [(1, "x " * 37 + items[0][1] + " y" * 9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert run(spark, df, items) == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination(cases.empty(spark), none).count() == 0
    rows = D.contamination(cases.awkward(spark), none).collect()
    assert rows and not any(r.contaminated for r in rows)


def test_native_plan(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id bigint, text string")
    text = D.contamination(cases.awkward(spark), items)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
