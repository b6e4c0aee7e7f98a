"""Language identification: scripts, word scores, and Viterbi spans for mixed texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, ship_package

UNKNOWN = "und"
# Labelled documents per language that the word scores are learned from, about.
SAMPLE_PER_LANGUAGE = 2000
# Hash buckets for the letter triples of words.
BUCKETS = 1 << 15
# What changing the language between two words costs, in natural logarithms.
SWITCH_PENALTY = 12.0
# Languages that are learned, those with the most labelled documents; labels of words are bytes.
MOST_LANGUAGES = 250
# A document is in the learned languages if this part of its letters is in words of any of them.
LEAST_SHARE = 0.2
# A language is a candidate for a script that at least this part of its learned letters are in.
SCRIPT_SHARE = 0.01

_IMPOSSIBLE = -1e4
# Characters scored at once, and characters of texts that go through Viterbi together.
_CHARS_AT_ONCE = 1 << 20
_CHARS_TOGETHER = 1 << 22

# First and last code point of the main ranges of scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}


@functools.cache
def _letters() -> np.ndarray:
    """Per code point 0 if it is no letter, else 1 + the number of its script (last: any other)."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if chr(c).isalpha()]] = len(SCRIPTS) + 1
    for number, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            part = kinds[first : last + 1]
            part[part > 0] = number + 1
    return kinds


@dataclass
class Words:
    """The words, runs of letters, of some texts one after another."""

    doc: np.ndarray  # number of the text
    start: np.ndarray  # code points, in the text
    end: np.ndarray
    script: np.ndarray
    first: np.ndarray  # place of the word's first triple
    triples: np.ndarray  # a bucket per letter, from it and its neighbours in the word


def words_of(texts: list[str]) -> Words:
    joined = "\n".join(texts) + "\n"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _letters()[raw]
    places = np.flatnonzero(kind)
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    new = np.ones(len(places), bool)
    new[1:] = np.diff(places) > 1
    last = np.ones(len(places), bool)
    last[:-1] = new[1:]
    # Lower case keeps one letter one letter, so places stay.
    lower = _lower()[raw[places]].astype(np.uint64)
    before, after = np.zeros_like(lower), np.zeros_like(lower)
    before[1:] = lower[:-1]
    before[new] = 0
    after[:-1] = lower[1:]
    after[last] = 0
    mixed = (before << np.uint64(42)) | (lower << np.uint64(21)) | after
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    triples = (mixed >> np.uint64(64 - 15)).astype(np.int32) & (BUCKETS - 1)
    first = np.flatnonzero(new)
    at = places[first]
    doc = np.searchsorted(offsets, at, "right") - 1
    start, end = (at - offsets[doc]).astype(np.int32), (places[last] + 1 - offsets[doc]).astype(np.int32)
    return Words(doc.astype(np.int32), start, end, kind[at] - 1, first, triples)


@functools.cache
def _lower() -> np.ndarray:
    codes = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(_letters()).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            codes[c] = ord(low)
    return codes


def _chunks(texts: list[str], most: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``most`` characters, with the number of the first."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages, logarithms of shares
    candidates: np.ndarray  # scripts x languages, 0 or _IMPOSSIBLE

    def word_scores(self, words: Words) -> np.ndarray:
        """A column per language, and a last one for words of none: all triples are equally likely."""
        n = len(self.languages)
        found = np.zeros((len(words.first), n + 1), np.float32)
        if len(found):
            found[:, :n] = np.add.reduceat(self.scores[words.triples], words.first, axis=0)
            found[:, :n] += self.candidates[words.script]
            found[:, n] = (words.end - words.start) * -np.log(BUCKETS)
        return found


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: the sum of its scores less ``penalty`` per change is largest.

    ``scores`` has the words of all texts one after another, ``sizes`` the words of each text. All
    texts go forward together, a word each at a time. Sums are kept relative to the best one, so they
    stay exact in any length of text.
    """
    n_texts, n_labels = len(sizes), scores.shape[1]
    labels = np.zeros(len(scores), np.uint8)
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    longest = int(sizes[0]) if n_texts else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")  # texts with more than t words
    came = np.zeros((len(scores), n_labels), np.uint8)
    value = np.zeros((n_texts, n_labels), scores.dtype)
    same = np.arange(n_labels, dtype=np.uint8)
    for t in range(longest):
        n = active[t]
        rows, now = starts[:n] + t, value[:n]
        if t:
            best = now.argmax(axis=1)
            switched = now[np.arange(n), best][:, None] - penalty
            came[rows] = np.where(now >= switched, same, best[:, None].astype(np.uint8))
            np.maximum(now, switched, out=now)
        now += scores[rows]
        now -= now.max(axis=1, keepdims=True)
    label = value.argmax(axis=1).astype(np.uint8)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        labels[rows] = label[:n]
        label[:n] = came[rows, label[:n]] if t else label[:n]
    return labels


def predict(model: Model, texts: list[str], penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, float, list]]:
    """(language, share of its letters, share of letters in any language, spans) per text.

    A span is (start, end, language), in ``und`` where the words are of no learned language.
    """
    return [found for _, some in _chunks(texts, _CHARS_TOGETHER) for found in _predict(model, some, penalty)]


def _predict(model: Model, texts: list[str], penalty: float) -> list[tuple[str, float, float, list]]:
    found: list[tuple[str, float, float, list]] = [(UNKNOWN, 0.0, 0.0, [])] * len(texts)
    parts = []
    for first, chunk in _chunks(texts, _CHARS_AT_ONCE):
        words = words_of(chunk)
        parts.append((words.doc + np.int32(first), words.start, words.end, model.word_scores(words)))
    if not parts or not model.languages:
        return found
    doc, start, end, scores = (np.concatenate(p) for p in zip(*parts))
    sizes = np.bincount(doc, minlength=len(texts))
    labels = viterbi(scores, sizes, penalty)
    n = len(model.languages)
    names = [*model.languages, UNKNOWN]
    letters = np.bincount(doc.astype(np.int64) * (n + 1) + labels, end - start, len(texts) * (n + 1))
    letters = letters.reshape(-1, n + 1)
    change = np.ones(len(doc), bool)
    change[1:] = (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])
    begins = np.flatnonzero(change)
    closes = np.concatenate((begins[1:], [len(doc)])) - 1
    spans: dict[int, list] = {}
    for a, b in zip(begins.tolist(), closes.tolist()):
        spans.setdefault(int(doc[a]), []).append((int(start[a]), int(end[b]), names[labels[a]]))
    total = letters.sum(axis=1)
    # Where no word is of a learned language, the one with the best scores is named, with share 0.
    likely = np.zeros((len(texts), n))
    np.add.at(likely, doc, scores[:, :n])
    best = np.where(letters[:, :n].any(axis=1), letters[:, :n].argmax(axis=1), likely.argmax(axis=1))
    for i, runs in spans.items():
        known = float(letters[i, :n].sum() / total[i])
        found[i] = (model.languages[best[i]], float(letters[i, best[i]] / total[i]), known, runs)
    return found


def _counted(sample: DataFrame) -> DataFrame:
    """Rows (lang, bucket, n) of the triples; scripts are buckets from ``BUCKETS`` on."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for _, chunk in _chunks(texts.tolist(), _CHARS_AT_ONCE):
                    words = words_of(chunk)
                    lengths = np.diff(np.append(words.first, len(words.triples)))
                    counts = np.bincount(words.triples, minlength=BUCKETS)
                    scripts = np.bincount(words.script, lengths, len(SCRIPTS) + 1).astype(np.int64)
                    every = np.concatenate((counts, scripts))
                    some = np.flatnonzero(every)
                    yield pd.DataFrame({"lang": lang, "bucket": some, "n": every[some]})

    return sample.mapInPandas(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    )


def held_out(id_col: Column) -> Column:
    """Documents kept out of learning; a document without id is none of them."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Word scores from about ``per_language`` labelled documents of each language.

    Of more than ``most_languages`` values of the label, those with the most documents are learned.
    The sample is drawn by a hash of the ids, so reruns agree. What comes to the driver is bounded
    by the number of languages times ``BUCKETS``, whatever the number of documents.
    """
    ship_package(docs.sparkSession)
    known = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col(id_col)))
    sizes = known.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(most_languages)
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(sizes), "lang").where(drawn * F.col("_n") < per_language)  # at most that many rows
    counts = _counted(sample.select("lang", "text")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(languages)))
    table[counts["bucket"], counts["lang"].map({x: i for i, x in enumerate(languages)})] = counts["n"]
    triples, scripts = table[:BUCKETS], table[BUCKETS:]
    shares = (triples + 0.5) / (triples.sum(axis=0) + 0.5 * BUCKETS)
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, np.log(shares).astype(np.float32), np.where(used, 0, _IMPOSSIBLE).astype(np.float32))


def labelled(text: Column, model: Model, spark: SparkSession, penalty: float = SWITCH_PENALTY) -> Column:
    """A struct of ``lang``, ``score``, ``known`` and ``spans`` for a text column; see ``identify``."""
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, known double, spans array<struct<start:int,end:int,lang:string>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = predict(sent.value, [t or "" for t in texts], penalty)
            yield pd.DataFrame({
                "lang": [f[0] for f in found],
                "score": [f[1] for f in found],
                "known": [f[2] for f in found],
                "spans": [[{"start": a, "end": b, "lang": c} for a, b, c in f[3]] for f in found],
            })

    return of(text)


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """The language of each text, from its letters alone.

    The script of a word narrows the languages it can be in; its letter triples score them; and
    the best path over all words, where each change of language costs ``penalty``, labels spans. Words
    that random letters explain better, such as those in a script of no learned language, are ``und``.
    ``lang_pred`` is the language of most letters, ``score`` their share of all letters, ``known`` the share
    of letters in any learned language, ``spans`` the runs of one language as (start, end, lang) in
    code points. A row per row; a text that is null or has no letter gets ``und``, score 0 and no span.
    """
    found = labelled(F.col(text_col), model, docs.sparkSession, penalty)
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("_l")).select(
        "doc_id", F.col("_l.lang").alias("lang_pred"), "_l.score", "_l.known", "_l.spans"
    )


def accepted(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The documents in the learned languages, also in several of them.

    Texts with less than ``least_share`` of their letters in words of any learned language are rejected, and
    so are texts without a letter, and null ones. A
    corpus without labels teaches no language; then whether there is a letter decides as well.
    Rows and columns stay as they are.
    """
    if not model.languages:
        return docs.where(F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False)))
    name = fresh(docs, "_language")
    found = docs.withColumn(name, labelled(F.col(text_col), model, docs.sparkSession, penalty))
    language = F.col(name)
    return found.where((language.lang != UNKNOWN) & (language.known >= least_share)).drop(name)
