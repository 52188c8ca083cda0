"""The registered queries of the training-data operators: each applies one
operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm import (
    bond, decontaminate, hnsw, katz, langid, licenses, oracle, packing, phrases, pii, repetition, simhash,
    substrings, toxicity)
from zonelake.llm.common import held_out, table


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", 3, 1)))
    return langid.predict(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.train(docs.select("doc_id", "text", "lang"),
                         labels.where(~held_out("doc_id", 4, 2)).select("doc_id", "toxic"), at=0.3)
    return toxicity.score(docs, net).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(table(spark, sf_dir, "documents"), width=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
                        "kept_sha256")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out("doc_id", 7, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~out & F.col("doc_id").isNotNull()).alias("train"))
    return katz.scores(docs).select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                                    "base_score", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=5, support=100, top=2000,
                                contained_percent=100)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                               .otherwise(F.col("label")))
    return bond.hard_negatives(moved, F.col("vec_id") % 50 == 0, positives=5, negatives=3,
                               low_percent=50, high_percent=95, scale=256)


def queries() -> dict:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_packing": op2_packing,
        "op3_toxicity": op3_toxicity,
        "op4_language_id": op4_language_id,
        "op5_licenses": op5_licenses,
        "op6_substrings": op6_substrings,
        "op7_nearest": op7_nearest,
        "op8_pii": op8_pii,
        "op9_katz": op9_katz,
        "op10_simhash": op10_simhash,
        "op11_repetition": op11_repetition,
        "op12_phrases": op12_phrases,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
