"""Repeated strings against a count of all windows."""

import random
from collections import Counter

import cases
import numpy as np
import pytest

from ledgerloom.llm import repeats


def brute(texts, size):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if counts[d[i : i + size]] > 1:
                covered[i : i + size] = b"\1" * size
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(d), sum(covered), runs, bytes(x for x, c in zip(d, covered) if not c)))
    return out


def run(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = repeats.without_repeats(df, min_bytes=size).collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sorted(rows)]


@pytest.mark.parametrize("size, small", [(8, {}), (1, {}), (20, {"_HOT_BYTES": 300}), (8, {"_HOT_BYTES": 100, "_BLOCK": 3}), (9, {"_HOT_BYTES": 50}), (12, {"_COUNT_ENTRIES": 10, "_WINDOWS_AT_ONCE": 40, "_SORTED_AT_ONCE": 50})])
def test_random_texts(spark, monkeypatch, size, small):
    """Shared passages, periodic runs, copies, cut characters; hot hashes split into parts."""
    for name, value in small.items():
        monkeypatch.setattr(repeats, name, value)
    random.seed(size)
    shared = ["the quick brown fox jumps", "über alles çà et là", "a" * 37, "xyz" * 20]
    texts = []
    for _ in range(120):
        text = "".join(random.choice("abcdé ") for _ in range(random.randint(0, 80)))
        for _ in range(random.randint(0, 2)):
            text += random.choice(shared) + "".join(random.choice("xyz") for _ in range(random.randint(0, 9)))
        texts.append(text)
    texts += texts[:10] + [None, "", "ab" * 60]
    assert run(spark, texts, size) == brute(texts, size)


def test_documents(spark):
    texts = cases.texts_of()
    ordered = [texts[i] for i in sorted(texts)]
    assert run(spark, ordered, 200) == brute(ordered, 200)


def test_windows_are_cut_alike():
    """Equal windows have equal smallest hashes wherever they stand."""
    random.seed(4)
    passage = bytes(random.choice(b"abcdefgh ") for _ in range(300))
    texts = [bytes(random.choice(b"abcdefgh ") for _ in range(n)) + passage for n in (0, 7, 211, 1000)]
    keys = []
    for number, text in enumerate(texts):
        found = {}
        for _, first, n, gram, _, _ in repeats.segments([text], 200):
            for a, k, g in zip(first.tolist(), n.tolist(), gram.tolist()):
                found |= {i: g for i in range(a, a + k)}
        assert sorted(found) == list(range(len(text) - 199))
        keys.append([found[len(text) - 300 + i] for i in range(101)])
    assert keys[0] == keys[1] == keys[2] == keys[3]


def test_expansion_gives_common_prefixes():
    """Bounds of increasing length against prefixes compared byte by byte."""
    rng = np.random.default_rng(1)
    data = np.append(rng.choice(list(b"ab"), 300), 255).astype(np.uint8)
    order = repeats.suffix_order(data, 16)
    raw = data.tobytes()
    for depth in (1, 3, 7, 12):
        bound = repeats.common_prefix_bounds(data, order, depth, 255)
        for row in range(1, len(data)):
            a, b = raw[order[row - 1] :][:depth], raw[order[row] :][:depth]
            if 255 not in a and 255 not in b and len(a) == len(b) == depth:
                assert bound[row] == (a != b)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = repeats.without_repeats(docs, min_bytes=20).collect()
    given = docs.collect()
    expected = brute([r.text for r in given], 20)
    key = lambda x: (str(x[0]), x[1:])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]
    assert sorted(got, key=key) == sorted([(r.doc_id, *e) for r, e in zip(given, expected)], key=key)
    assert repeats.without_repeats(cases.empty(spark)).count() == 0
