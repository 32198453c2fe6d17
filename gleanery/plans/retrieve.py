"""From questions to hits, prompts and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanery.operators.context import filled, gathered, joined
from gleanery.operators.embedding import Embedder, embed_queries
from gleanery.operators.messages import non_empty
from gleanery.operators.topk import FEW_HITS, K, OWNER_BYTES, QUESTION_BYTES, nearest_rows


def retrieve(
    queries: DataFrame,
    documents: DataFrame,
    ownership: DataFrame,
    embedder: Embedder,
    k: int = K,
    broadcast_bytes: int = QUESTION_BYTES,
    owner_bytes: int = OWNER_BYTES,
    few_hits: int = FEW_HITS,
) -> DataFrame:
    """``qid, rank, document_id, url_key, chunk, dist`` of every non-empty question.

    Ranking reads only ``id, embed``; the chunk text is fetched for the few hits. How many
    questions a task holds, and how many hits are broadcast, is for the caller to bound;
    ``Store.served_documents`` are fetched without an exchange at any number.
    """
    asked = embed_queries(non_empty(queries), embedder)
    hits = nearest_rows(asked, documents, ["url_key", "chunk"], k, ownership, broadcast_bytes, owner_bytes, few_hits)
    return hits.select("qid", "rank", "document_id", "url_key", "chunk", "dist")


def prompts(
    queries: DataFrame,
    documents: DataFrame,
    ownership: DataFrame,
    embedder: Embedder,
    template: str,
    k: int = K,
    broadcast_bytes: int = QUESTION_BYTES,
    owner_bytes: int = OWNER_BYTES,
    few_hits: int = FEW_HITS,
) -> DataFrame:
    """One row per non-empty question: the model input and the evidence shown with it."""
    hits = gathered(retrieve(queries, documents, ownership, embedder, k, broadcast_bytes, owner_bytes, few_hits))
    model_input = filled(template, joined("chunk", "\n\n"), F.col("prompt"))
    return non_empty(queries).join(hits, "qid", "left").select(
        "qid",
        "prompt",
        model_input.alias("model_input"),
        joined("chunk", "\n").alias("chunks"),
        joined("url_key", "\n").alias("urls"),
    )
