"""From raw documents to packed sequences: each stage's rows are written as Parquet and read again by the next.

Quality rules, language identification and near-duplicate removal drop documents; suffix-array dedup cuts passages that
stand earlier out of the texts; packing puts the token streams of what is left into windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, langid, packing, quality, simhash, suffix


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: No SQL can express these stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.durable(stage(spark, docs, sf_dir))
    return docs
