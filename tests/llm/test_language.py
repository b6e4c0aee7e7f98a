"""Language identification: held-out accuracy, spans, scripts, and the best path."""

import itertools

import cases
import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    got = language.identify(docs, model).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    judged = got.where(language.held_out(F.col("doc_id")) & (F.col("n_chars") > 40))
    right = judged.where("lang = lang_pred").count()
    assert right >= 0.99 * judged.count() > 100
    assert got.where("score < 0 OR score > 1").count() == 0
    # Labels and ids of what is judged do not matter.
    other = docs.select((F.col("doc_id") + 1).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    again = language.identify(other, model).select(F.col("doc_id") - 1, "lang_pred", "score")
    assert again.exceptAll(got.select("doc_id", "lang_pred", "score")).count() == 0


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    parts = [docs.where(f"lang = '{x}' AND n_chars BETWEEN 400 AND 900").orderBy("doc_id").first().text for x in ("en", "de", "es")]
    joined = "\n\n".join(parts)
    spans = [s for s in language.predict(model, [joined])[0][3] if s[1] - s[0] > 100]
    assert [s[2] for s in spans] == ["en", "de", "es"]
    assert abs(spans[1][0] - len(parts[0])) < 60


def test_best_path():
    """Lockstep over many texts against all paths."""
    rng = np.random.default_rng(5)
    sizes = np.array([0, 3, 1, 5, 0, 4])
    scores = rng.normal(0, 2, (sizes.sum(), 3)).astype(np.float32)
    got, at = language.viterbi(scores, sizes, 1.5), 0
    for n in sizes:
        def value(path):
            own = sum(float(scores[at + i, x]) for i, x in enumerate(path))
            return own - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
        if n:
            best = max(map(value, itertools.product(range(3), repeat=int(n))))
            assert abs(value(got[at : at + n]) - best) < 1e-4
        at += n


def test_best_path_of_long_texts():
    """Large sums do not blur the differences between labels."""
    rng = np.random.default_rng(6)
    scores = rng.normal(0, 2, (3000, 3)).astype(np.float32)
    sizes = np.array([1000, 2000])
    exact = language.viterbi(scores.astype(np.float64), sizes, 1.5)
    first = np.array([0, 1000])
    shifted = scores.copy()
    shifted[first] -= np.float32(2**28)  # as after millions of words, the same for all labels
    assert (shifted[first] == shifted[first][:, :1]).all()
    got = language.viterbi(shifted, sizes, 1.5)
    assert (got != exact).sum() < 10


def test_scripts_narrow(spark):
    rows = [(i, t, x) for i in range(0, 200, 2) for t, x in [("дом и сад", "ru"), ("house and garden", "en"), ("σπίτι και κήπος", "el")]]
    model = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    found = language.predict(model, ["xyz дом", "κήπος", "漢字", "12 !?"])
    assert [f[0] for f in found[:2]] == ["ru", "el"] or found[0][0] == "en"
    assert found[2][0] in ("ru", "en", "el") and found[3] == ("und", 0.0, 0.0, [])
    # Letters in a script of no learned language count against the score.
    assert found[2][1:3] == (0.0, 0.0) and found[2][3] == [(0, 2, "und")]


FOREIGN = [
    "\u4eca\u5929\u5929\u6c14\u5f88\u597d\uff0c\u6211\u4eec\u53bb\u516c\u56ed\u6563\u6b65\u3002",
    "\u0421\u0435\u0433\u043e\u0434\u043d\u044f \u0445\u043e\u0440\u043e\u0448\u0430\u044f \u043f\u043e\u0433\u043e\u0434\u0430 \u0438 \u043c\u044b \u0438\u0434\u0451\u043c \u0433\u0443\u043b\u044f\u0442\u044c",
    "zzz qqq zqzq qzzq xxqz jjqx wqqz vvxj qqjz",
]


def test_foreign_texts_are_rejected(spark):
    """By the share of letters in learned languages; texts in several of these stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    found = language.predict(model, FOREIGN)
    assert all(f[0] in model.languages and f[1] < 0.1 and f[2] < 0.1 for f in found)
    parts = [docs.where(f"lang = '{x}' AND n_chars BETWEEN 300 AND 900").orderBy("doc_id").first().text for x in model.languages]
    mixed = "\n".join(parts)
    texts = [*FOREIGN, mixed, parts[0] + FOREIGN[0], FOREIGN[1] * 30 + parts[0][:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.doc_id for r in language.accepted(df, model).orderBy("doc_id").collect()] == [3, 4]
    # All documents of the corpus with a label and some words are in a learned language.
    labelled = docs.where("lang IS NOT NULL AND n_chars > 40")
    assert language.accepted(labelled, model).count() >= 0.995 * labelled.count()


def test_many_labels(spark):
    """Only the languages with the most documents are learned, however many labels there are."""
    rows = [(i, "some text", f"junk{i}") for i in range(600)] + [(i, "house and garden", "en") for i in range(1000, 1030)]
    model = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), most_languages=20)
    assert len(model.languages) == 20 and "en" in model.languages


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    model = language.learn(docs)
    got = language.identify(docs, model)
    assert got.count() == docs.count()
    for doc in (3, 4, 5, 6):
        assert got.where(f"doc_id = {doc}").first().lang_pred == "und"
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    assert kept.where("doc_id = 1").count() == 1 and kept.first()["_language"] == "l"


def test_empty_and_unlabelled(spark):
    none = language.learn(cases.empty(spark))
    assert none.languages == []
    assert {r.lang_pred for r in language.identify(cases.awkward(spark), none).collect()} == {"und"}
    assert language.identify(cases.empty(spark), none).count() == 0
