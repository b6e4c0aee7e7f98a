"""Token counts by a linear longest-match automaton over a vocabulary."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_package

WORD_START = "\u2581"

# Distinct words whose counts a worker keeps at a time.
_KEPT_WORDS = 200_000


class Automaton:
    """Counts the pieces that greedy longest match cuts a word into, in one pass over it.

    A trie of the pieces, where each node has a failure link to the node of what is left after
    popping pieces off the front of its text, and the number of pieces popped on that way. A
    character that no piece starts with, or that can only be cut off alone and is no piece, counts
    as its UTF-8 bytes (byte fallback).
    """

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.cost = [0]  # of the node's text as one piece, 0 if it is none
        for piece in pieces:
            if piece:
                self.cost[self._node(piece)] = 1
        # Every character on an edge can be popped alone, by its bytes if it is no piece.
        for char in {c for edges in self.next for c in edges}:
            node = self._node(char)
            self.cost[node] = self.cost[node] or len(char.encode("utf-8", "surrogatepass"))
        self.fail, self.popped = [-1] * len(self.next), [0] * len(self.next)
        level = [0]
        while level:
            deeper = []
            for parent in level:
                for char, node in self.next[parent].items():
                    self._link(parent, char, node)
                    deeper.append(node)
            level = deeper

    def _node(self, text: str) -> int:
        node = 0
        for char in text:
            found = self.next[node].get(char)
            if found is None:
                found = len(self.next)
                self.next[node][char] = found
                self.next.append({})
                self.cost.append(0)
            node = found
        return node

    def _link(self, parent: int, char: str, node: int) -> None:
        if self.cost[node]:
            self.fail[node], self.popped[node] = 0, self.cost[node]
            return
        # The parent's text without its first pieces, until the character fits on.
        at, popped = self.fail[parent], self.popped[parent]
        while char not in self.next[at]:
            popped += self.popped[at]
            at = self.fail[at]
        self.fail[node], self.popped[node] = self.next[at][char], popped

    def count(self, word: str) -> int:
        following, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for char in word:
            found = following[node].get(char)
            while found is None and node:
                total += popped[node]
                node = fail[node]
                found = following[node].get(char)
            if found is None:
                total += len(char.encode("utf-8", "surrogatepass"))
            else:
                node = found
        while node:
            total += popped[node]
            node = fail[node]
        return total


def read_vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece model, or of the JSON file of a tokenizer whose words start
    with a mark, without special and byte pieces."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        return [model.id_to_piece(i) for i in range(model.vocab_size()) if not special(i)]
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    return list(model["vocab"])


def token_counts(
    docs: DataFrame,
    pieces: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    word_start: str = WORD_START,
) -> DataFrame:
    """``n_words`` and ``n_tokens`` per document.

    Words end at ASCII white space. Each word, with ``word_start`` before it, is cut into the
    longest pieces from the left; only their number is made, by one pass of the automaton. What no
    piece covers counts as bytes. The vocabulary is sent to the executors, so it has to be of a
    tokenizer's size.

    A row per row with id, ``n_words`` and ``n_tokens``; null and empty texts have 0 of both.
    """
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.pandas_udf("n_words bigint, n_tokens bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(sent.value)
        kept: dict[bytes, int] = {}

        def tokens(word: bytes) -> int:
            found = kept.get(word)
            if found is None:
                if len(kept) >= _KEPT_WORDS:
                    kept.clear()
                found = kept[word] = automaton.count(word_start + word.decode("utf-8", "surrogatepass"))
            return found

        for texts in batches:
            rows = []
            for text in texts:
                words = Counter((text or "").encode("utf-8", "surrogatepass").split())
                rows.append((words.total(), sum(tokens(w) * n for w, n in words.items())))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"], dtype="int64")

    counted: Column = count(F.col(text_col)).alias("_n")
    return docs.select(F.col(id_col).alias("doc_id"), counted).select("doc_id", "_n.n_words", "_n.n_tokens")
