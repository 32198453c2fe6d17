"""Who contributed which chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanery.operators.chunks import chunk_count, document_id
from gleanery.operators.sizing import broadcast_if_small


def ownership_edges(texts: DataFrame) -> DataFrame:
    """Distinct (document_id, user_id) of events ``url_key, user_id, n_words``.

    A page's chunks are offsets 0..n-1, so the union of a user's edges over several
    events of one page is the range of the longest. One narrow row per event is
    shuffled (after map-side combine), never one row per chunk.
    """
    longest = texts.groupBy("url_key", "user_id").agg(F.max(chunk_count(F.col("n_words"))).alias("n"))
    owned = longest.where(F.col("n") > 0).withColumn(
        "offset", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    )
    return owned.select(document_id(F.col("url_key"), F.col("offset")).alias("document_id"), "user_id")


def documents_for_user(documents: DataFrame, ownership: DataFrame, user_id: str) -> DataFrame:
    """Documents the user contributed to; edges act as a set. A user's edges are measured
    first: when few, the documents are filtered where they lie."""
    mine = ownership.where(F.col("user_id") == user_id).select(F.col("document_id").alias("id")).distinct()
    return documents.join(broadcast_if_small(mine), "id", "left_semi").select(*documents.columns)
