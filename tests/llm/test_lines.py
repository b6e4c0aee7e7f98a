"""Lines that repeat across documents against a plain count of all keys."""

import random
from collections import defaultdict

import cases
import numpy as np
import pytest

from ledgerloom.llm import lines as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(docs, shortest=10):
    last = (1, 0)
    place = lambda i: last if i is None else (0, i)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(place(i))
    out = []
    for i, text in docs:
        all_lines = (text or "").split("\n")
        stays = lambda x: len(key(x)) < shortest or min(holders[key(x)]) == place(i)
        kept = [x for x in all_lines if stays(x)]
        out.append((i, text, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(spark, docs, **more):
    df = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    return sorted(map(tuple, L.without_repeated_lines(df, **more).collect()), key=repr)


def random_docs(seed):
    random.seed(seed)
    stock = [f"A line number {i} of the stock" for i in range(40)] + ["short", "nine char", "ten chars.", "你" * 9, "你" * 10, ""]
    blank = ["", " ", "\t ", "\x0b", "\r"]
    draw = lambda: random.choice(blank) + random.choice([str, str.upper])(random.choice(stock)) + random.choice(blank)
    docs = [(i, "\n".join(draw() for _ in range(random.randint(0, 12)))) for i in range(-5, 40)]
    return docs + [(90, None), (91, ""), (92, "\n\n"), (None, draw()), (None, docs[3][1]), docs[3], docs[3]]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    docs = random_docs(seed)
    assert run(spark, docs) == brute(docs)


def test_full_filters_change_nothing(spark, monkeypatch):
    """A filter much too small makes every line a suspect; an empty one would lose repeats."""
    docs = random_docs(9) + [(1000 + i, f"only here {i}\nand in all of them") for i in range(300)]
    expected = brute(docs)
    monkeypatch.setattr(L, "twice_seen", lambda texts, shortest: bytearray(b"\xff" * 8192))
    assert run(spark, docs) == expected


def test_few_lines_are_suspects(spark):
    """Of lines that occur once, only some share all bits with others."""
    docs = [(i, "\n".join(f"line {i} {k} of its own" for k in range(20))) for i in range(500)] + [(900, "line 3 4 of its own")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    bits = np.frombuffer(bytes(L.twice_seen(df, 10)), dtype=np.uint8)
    assert len(bits) * 8 >= 16 * 10_001 / 2
    wanted = L._halves([L.line_digests("line 3 4 of its own", 10)[1][0]])
    others = L._halves([d for _, t in docs[:400] for d in L.line_digests(t, 10)[1]])
    mask = np.uint64(len(bits) * 8 - 1)
    found = lambda h: ((bits[((p := h.astype("<u8") & mask) >> np.uint64(3)).astype(int)] >> (p & np.uint64(7)).astype("u1")) & 1).all(axis=1)
    assert found(wanted).all() and found(others).mean() < 0.1


def test_filter_size_is_bounded():
    assert L.filter_bits(0) == L._PAGE_BITS
    assert L.filter_bits(10**12) == L.FILTER_BYTES * 8
    assert 16 * 10**6 <= L.filter_bits(10**6) <= 32 * 10**6


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(spark, docs) == brute(pairs)
    assert run(spark, cases.empty(spark)) == []


def test_shortest_is_an_argument(spark):
    docs = [(1, "ab\nabc"), (2, "AB\n abc "), (3, "éb\nÉb")]
    assert run(spark, docs, shortest=2) == brute(docs, 2)


def test_text_ids_and_other_names(spark):
    docs = [("b", "the same long line"), ("a", "the same long line\nand another"), (None, "The same long line")]
    df = spark.createDataFrame(docs, "name string, body string")
    got = {r.doc_id: r.kept for r in L.without_repeated_lines(df, "name", "body").collect()}
    assert got == {"a": "the same long line\nand another", "b": "", None: ""}


def test_one_line_in_most_documents(spark, conf):
    """A line that a third of all rows hold is grouped by partial sums; its rows are split."""
    conf({"spark.sql.shuffle.partitions": "5"})
    docs = [(i, f"a very common line\nbut this is number {i}") for i in range(3000)]
    rows = L.without_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8))
    assert rows.where("n_dropped = 1").count() == 2999
    assert rows.where("n_dropped = 0").first().doc_id == 0


def test_long_texts_with_many_lines(spark):
    docs = [(1, "same old line\n" * 100_000), (2, "\n" * 200_000 + "same old line"), (3, "x" * 500_000)]
    assert run(spark, docs) == brute(docs)
