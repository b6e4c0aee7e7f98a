"""One registered query per text operator, with the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontaminate,
    dialogue,
    fingerprints,
    language,
    lines,
    mixing,
    phrases,
    pii,
    repeats,
    secret_scan,
    simhash,
    tokens,
    urls,
)
from ledgerloom.llm.common import table

# A secret in production; fixed here so that reruns agree.
PII_KEY = "example key"

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES = {}
ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op2_mix": mixing.ORACLE,
    "op3_urls": urls.ORACLE,
    "op11_dialogue": dialogue.ORACLE,
    "op12_lines": lines.ORACLE,
    "op13_phrases": phrases.ORACLE,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    listed = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


@query
def op2_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query
def op3_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), urls.RULES)


@query
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf, "documents"))

    def count(kind: str):
        return F.size(F.filter("plain", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listed(F.col("plain")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query
def op6_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fingerprints.with_next(table(spark, sf, "documents"))
    return pairs.select(
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.packed(F.col("bins")).alias("fingerprint"),
        fingerprints.packed(F.col("edited_bins")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        fingerprints.likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
        "next_id",
    )


@query
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with pseudonyms, and how many values of each kind were found."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = pii.pseudonymise(docs, key=PII_KEY, counts="found")
    per_kind = [F.col("found")[k].alias(f"n_{k}") for k in pii.KINDS]
    return done.select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"), *per_kind)


@query
def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@query
def op9_repeats(spark: SparkSession, sf: str) -> DataFrame:
    left = repeats.without_repeats(table(spark, sf, "documents"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_tokens(spark: SparkSession, sf: str) -> DataFrame:
    pieces = tokens.read_vocabulary(VOCABULARY)
    return tokens.token_counts(table(spark, sf, "documents"), pieces)


@query
def op11_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations")
    edits, summary = dialogue.repair(dialogue.damaged(given), copies=F.col("copies"))
    repaired = summary.drop("conv_id").join(dialogue.digests(edits), "conv")
    ids = given.select("conv_id", dialogue.conversation_key(F.col("conv_id")).alias("conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(repaired, "conv", "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_lines(spark: SparkSession, sf: str) -> DataFrame:
    left = lines.without_repeated_lines(table(spark, sf, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))
