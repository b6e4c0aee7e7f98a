"""Token counts against greedy matching that builds the pieces."""

import random

import cases
import pytest

from ledgerloom.llm import tokens
from ledgerloom.llm.queries import VOCABULARY


def greedy(word, pieces, longest):
    """Pieces cut off the front, longest first; a character without a piece gives its bytes."""
    n = at = 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in pieces:
                n, at = n + 1, end
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
    return n


@pytest.mark.parametrize("seed", range(5))
def test_random_vocabularies(seed):
    random.seed(seed)
    draw = lambda n: "".join(random.choice("abcé") for _ in range(n))
    pieces = {draw(random.randint(1, 6)) for _ in range(random.choice([3, 20, 200]))} | {"▁", "▁ab"}
    automaton = tokens.Automaton(sorted(pieces))
    for _ in range(2000):
        word = random.choice(["", "▁"]) + draw(random.randint(0, 25)) + random.choice(["", "z", "你"])
        assert automaton.count(word) == greedy(word, pieces, 7), word


def test_documents(spark):
    pieces = tokens.read_vocabulary(VOCABULARY)
    known, longest = set(pieces), max(map(len, pieces))
    texts = cases.texts_of()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for row in tokens.token_counts(docs, pieces).collect():
        words = (texts[row.doc_id] or "").encode().split()
        assert row.n_words == len(words)
        assert row.n_tokens == sum(greedy("▁" + w.decode(), known, longest) for w in words)


def test_json_vocabulary(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"vocab": {"a": 0, "ab": 1}}}')
    assert tokens.read_vocabulary(str(path)) == ["a", "ab"]


def test_awkward_rows(spark, monkeypatch):
    docs = cases.awkward(spark)
    got = tokens.token_counts(docs, ["▁long", "lo", "w"])
    assert got.count() == docs.count()
    of = {r.doc_id: (r.n_words, r.n_tokens) for r in got.where("doc_id IS NOT NULL").collect()}
    assert of[3] == of[4] == of[5] == (0, 0) and of[12] == (30_000, 30_000)
    assert tokens.token_counts(cases.empty(spark), ["a"]).count() == 0
    assert tokens.token_counts(docs, []).where("doc_id = 7").first().n_tokens == 3 + 4
