"""One registered query for each operator, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontamination, language, licenses, mixing, near_dup, pii, prefix_trie, quality, secrets, token_file, toxicity, unigram
from .common import crc32_of, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def of_kind(i: int):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
                        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"),
                                unigram.load_vocabulary(tokenizer_path("piece_bpe_32k.model")))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.default_templates(spark))
    return found.select("doc_id", "n_words", F.size("matches").cast("long").alias("n_licenses"),
                        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
                        F.array_max(F.transform("matches", lambda m: m["containment"])).alias("containment"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts, labels = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), crc32_of(F.col("doc_id")) % 3 != 1)
    model = toxicity.fit_toxicity(texts, labels)
    scored = toxicity.score_texts(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (crc32_of(F.col("doc_id")) % 3 == 1).alias("held_out"), "score", "predicted")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = language.training_rows(docs, crc32_of(F.col("doc_id")) % 4 != 2)
    model = language.fit_language([r[0] for r in rows], [r[1] for r in rows])
    found = language.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", (crc32_of(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.tokens_of(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_pii(table(spark, sf_dir, "documents")).withColumn("base", pii.of_base(F.col("spans")))

    def of_kind(i: int):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:pii.N_BASE])],
                        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"),
                        F.array_max(F.transform("spans", lambda s: s["score"])).alias("score"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontamination, op2_secrets, op3_token_counts, op4_licenses, op5_toxicity, op6_near_duplicates, op7_language,
    op8_token_file, op9_quality, op10_mixing, op11_collocations, op12_prefix_trie, op13_pii)}
