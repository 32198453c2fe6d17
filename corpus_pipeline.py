"""A filtering pipeline over the documents, one operator of ``gleanery.llm`` for each stage.

Quality rules drop documents that fail by themselves or with their host; one document of
each group of near-duplicates stays; documents holding a benchmark passage go; secrets are
masked in the texts that are left; these are encoded. A stage reads what the one before it
wrote.

The stages keep null and empty texts, rows without an id, repeated rows and columns of any
name as their operators' modules state; an empty text has too few words and goes in the first
stage. Very long texts are handled whole. Without documents every stage returns no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanery.llm.bpe import encode
from gleanery.llm.decontaminate import decontaminate
from gleanery.llm.host_rules import filter_quality
from gleanery.llm.near_dedup import drop_near_duplicates
from gleanery.llm.secret_scan import redact
from gleanery.llm.texts import read
from gleanery.session import configure, scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids, whole): whole if decoding gives the text back."""
    configure(spark)
    found = encode(docs, RANKS, public_tokenizers.PATTERN)
    same = F.col("bpe.decoded") == F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return found.select("doc_id", "source", "lang", F.size("bpe.ids").cast("bigint").alias("n_tokens"), "bpe.ids", same.alias("whole"))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("benchmark passages", benchmark),
    ("secrets", secrets),
    ("byte-level BPE", tokens),
]

ORACLE_SQL = None  # the links of near-duplicates and BPE are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
