"""From raw documents to a token file: the corpus pipeline and its stages.

Each stage is a function of (spark, docs, sf_dir) and reads what the stage
before it kept; ``run`` writes every stage's rows to the shared folder and reads
them again, so a lost executor costs no more than the stage it worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from causeway.llm import decontamination, mixing, near_dup, quality, token_file
from causeway.llm.common import shared_path, table
from causeway.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled thresholds.

    Null and empty texts have no words and go. A null language is a stratum of
    its own. Rows that repeat an id are judged each by its text; ties do not occur. Without
    labels the base rules decide. Columns may have any name; an empty table stays empty.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest id, of equal ids the first text.

    Texts without words (null, empty) all stay; of rows that repeat an id and
    text one stays. Long texts count whole. Columns may have any name; an empty table stays empty.
    """
    return near_dup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts hold none and stay, rows that repeat an id go or stay
    each by its text, and a null id is an id. An empty benchmark removes nothing.
    Columns may have any name; an empty table stays empty.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, the last repeat cut where its source's budget ends.

    Null and empty texts have no words and are taken never. A null source is a
    source. Rows that repeat an id take their own places, in the order of their size.
    Columns may have any name; an empty table stays empty.
    """
    return mixing.sample_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in a file, and the digests read back from it.

    A null or empty text is its end id alone; null ids come first, rows that
    repeat an id in the order of their texts. Long texts are encoded whole.
    Other columns are not written; an empty table gives an empty file and result.
    """
    return token_file.tokens_of(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("token_file", write_tokens)]

# Tokenizing and exact binomial bounds are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
