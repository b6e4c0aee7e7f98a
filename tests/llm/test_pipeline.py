"""The pipeline, stage by stage, against brute force."""

import re

import cases
import duckdb
import oracle
import test_decontaminate
import test_language
import test_pii
import test_simhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import mixing, pii


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], cases.SF))
    return out


def test_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    texts = cases.texts_of()
    _, spoken, single, clean, private, mixed = stages(spark, docs)
    columns = docs.columns
    assert all(d.columns == columns for d in (spoken, single, clean, private))
    kept = {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert {r.doc_id for r in spoken.collect()} == kept

    prints = {i: test_simhash.plain(texts[i]) for i in kept}
    kept = {i for i, root in test_simhash.groups(prints).items() if i == root}
    assert {r.doc_id for r in single.collect()} == kept

    items = duckdb.sql(f"SELECT item_id, text FROM '{cases.SF}/benchmark.parquet'").fetchall()
    found = test_decontaminate.brute([(i, texts[i]) for i in kept], items)
    kept = {i for (i, _), result in found.items() if not result[3]}
    assert {r.doc_id for r in clean.collect()} == kept

    after = {r.doc_id: r.text for r in private.collect()}
    assert set(after) == kept
    for i, text in after.items():
        assert len(text) == len(texts[i])
        for m in re.finditer(pii.ANY, texts[i]):
            none = re.fullmatch("[0-9 -]{13,}", m[0]) and test_pii.luhn(m[0]) != 0
            assert (m[0] in text) == bool(none)

    path = str(tmp_path / "documents.parquet")
    private.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    cursor = con.execute(mixing.ORACLE)
    names = [c[0] for c in cursor.description]
    rows = [tuple(r) for r in mixed.collect()]
    assert oracle.compare(mixed.columns, rows, names, cursor.fetchall()) == ""
    run = corpus_pipeline.run(spark, cases.SF)
    assert sorted(map(str, run.collect())) == sorted(map(str, mixed.collect()))


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    _, spoken, single, clean, private, mixed = stages(spark, docs)
    assert private.columns == docs.columns
    # The repeated row and the copies stay once; texts without letters go.
    ids = sorted(str(r.doc_id) for r in single.collect())
    assert ids.count("0") == 1 and not {"1", "3", "4", "5", "6", "None"} & set(ids)
    assert mixed.count() == private.count() == clean.count()


def test_texts_of_many_languages_stay(spark):
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = whole.select("doc_id", "text", "lang")
    parts = [r.text for r in whole.where("n_chars BETWEEN 400 AND 900").groupBy("lang").agg(F.first("text").alias("text")).orderBy("lang").collect()]
    greek = "\u03c3\u03c0\u03af\u03c4\u03b9 \u03ba\u03b1\u03b9 \u03ba\u03ae\u03c0\u03bf\u03c2 " * 30
    assert len(parts) >= 4
    joined = ["\n\n".join(p[:400] for p in parts[:n]) for n in (1, 2, 3, 4)] + ["\n\n".join([*(p[:400] for p in parts[:4]), greek])]
    added = [(-1 - i, text, None) for i, text in enumerate(joined)] + [(-9, "12 !", None)]
    taught = [(10**9 + i, greek, "el") for i in range(40)]
    more = docs.unionByName(spark.createDataFrame(added + taught, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, more, "").where("doc_id < 0").collect()}
    assert kept == {-1, -2, -3, -4, -5}
    unlabelled = more.withColumn("lang", F.lit(None).cast("string"))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, unlabelled, "").where("doc_id < 0").collect()}
    assert kept == {-1, -2, -3, -4, -5}


def test_empty_table(spark):
    assert [d.count() for d in stages(spark, cases.empty(spark))] == [0] * 6


def test_foreign_documents_go(spark):
    """The language stage rejects texts in no learned language, and only these."""
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    foreign = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(test_language.FOREIGN)], "doc_id bigint, text string")
    others = [F.lit(None).cast(t).alias(c) for c, t in docs.dtypes if c not in ("doc_id", "text")]
    all_docs = docs.unionByName(foreign.select("*", *others))
    _, stage = corpus_pipeline.STAGES[0]
    kept = {r.doc_id for r in stage(spark, all_docs, cases.SF).select("doc_id").collect()}
    assert kept == {i for i, t in cases.texts_of().items() if any(c.isalpha() for c in t or "")}
