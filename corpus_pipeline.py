"""From raw documents to packed training sequences, in five stages, each written as parquet before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, jaccard, langid, mixing, packing
from tidemark.llm.common import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts too) or with no language of at least even odds go; an empty table stays empty."""
    return langid.identified(docs, langid.train(docs.where(~langid.held_out("doc_id"))))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that are equal but for white space the one with the longest text stays, then the smallest id; null ids come last,
    then the row's place decides. Null counts as empty."""
    return exact_dedup.kept_rows(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by near copies (similarity of 0.8 or more on shingles of five words) the smallest id stays;
    null ids come last, then the row's place decides. Rows without words have no links and stay."""
    return jaccard.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three quarters of the tokens by the target weights; documents of short sources stand twice. Null
    texts have no tokens, null languages and sources are groups of their own."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of up to 1024 tokens; null texts are their end id alone."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language ID", language_id),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", one_of_similar),
    ("mixing to target weights", mixture),
    ("packing", packed),
]

#: The stages learn a model, solve a similarity join and tokenise, which SQL doesn't express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are a written table, so lost executors cost no earlier stage."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
