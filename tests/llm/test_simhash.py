"""SimHash groups against all pairs."""

import itertools
import random
import re

import cases
import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.queries import op8_simhash


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    each = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in each]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """id -> smallest linked id, for {id: fingerprint}."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in prints}


def test_query(spark):
    texts = cases.texts_of()
    prints = {i: plain(t) for i, t in texts.items()}
    expected = {i: (f"{prints[i]:016x}", c) for i, c in groups(prints).items()}
    assert {r[0]: (r[1], r[2]) for r in op8_simhash(spark, cases.SF).collect()} == expected


def test_spark_hash_is_the_same(spark):
    got = spark.sql("SELECT xxhash64('a b é')").first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), 42)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    random.seed(radius)
    for _ in range(5000):
        flipped = sum(1 << b for b in random.sample(range(64), radius))
        assert any(m & flipped == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_wider_masks_cover_what_a_mask_avoids(radius):
    random.seed(radius)
    for mask in simhash.covering_masks(radius):
        wider = simhash.wider_masks(mask, radius)
        assert all(m & mask == mask and m.bit_count() > mask.bit_count() for m in wider)
        assert radius < 3 or all(64 - m.bit_count() <= 16 for m in wider)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(500):
            flipped = sum(1 << b for b in random.sample(free, radius))
            assert any(m & flipped == 0 for m in wider)


def test_hot_buckets_meet_in_proportion(spark):
    """20,000 prints that agree in half their bits: blocks alone would make 78 copies of a bucket."""
    mask = simhash.covering_masks()[0]
    free = [b for b in range(64) if not mask >> b & 1]
    random.seed(1)
    values = {sum(1 << b for b in free if random.random() < 0.5) for _ in range(20_000)}
    signed = [int(np.array(v, np.uint64).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = simhash.near_links(df, block=256, hot_blocks=16)
    found = {r.node: r.root for r in simhash.smallest_reachable(links).collect()}
    plain = {r.node: r.root for r in simhash.smallest_reachable(simhash.near_links(df, block=256, hot_blocks=1 << 20)).collect()}
    assert found == plain and found


@pytest.mark.parametrize("block, hot_blocks", [(1024, 16), (7, 16), (7, 1), (1, 1), (1024, 0)])
def test_chains_and_large_groups(spark, block, hot_blocks):
    """Chains of small steps, a dense cloud, and lone prints; also with buckets cut into blocks and spread anew."""
    random.seed(block)
    values, at = set(), random.getrandbits(64)
    for _ in range(60):
        values.add(at)
        for b in random.sample(range(64), 3):
            at ^= 1 << b
    centre = random.getrandbits(64)
    for _ in range(150):
        value = centre
        for b in random.sample(range(64), random.randint(0, 4)):
            value ^= 1 << b
        values.add(value)
    values |= {random.getrandbits(64) for _ in range(100)} | {0, 1, 3, 7, 15, 31}
    signed = [int(np.array(v, np.uint64).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    links = simhash.near_links(df, block=block, hot_blocks=hot_blocks)
    got = {r.node: r.root for r in simhash.smallest_reachable(links).collect()}
    expected = groups(dict(zip(signed, signed)) | {})
    prints = dict(zip(signed, values))
    expected = groups({s: prints[s] for s in sorted(signed)})
    assert {s: got.get(s, s) for s in signed} == expected


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[3].fingerprint == of[4].fingerprint == of[5].fingerprint == "0" * 16 and of[5].component_id == 3
    assert of[1].component_id == 0 and of[0].is_first and not of[1].is_first
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["0", "3"]
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_only_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x")], "doc_id bigint, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert all(r.component_id is None and r.is_first for r in rows)
