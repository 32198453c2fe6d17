"""Overlapping word chunks and the document rows made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.functions.text import words

SIZE, OVERLAP = 512, 128  # fixed values, in words


def chunk_count(n_words: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Number of chunks a text of ``n_words`` yields."""
    return F.ceil(n_words / F.lit(size - overlap)).cast("int")


def chunk_words(
    df: DataFrame, text_col: str = "text", size: int = SIZE, overlap: int = OVERLAP
) -> DataFrame:
    """One row per chunk: the other columns plus ``offset`` and ``chunk``.

    A chunk starts every ``size - overlap`` words; the last may lie wholly inside its
    predecessor and is still emitted. The word array is computed once per text and the
    generator streams the starts, so no intermediate array of chunks is held.
    """
    step = size - overlap
    split = df.withColumn("_words", words(F.col(text_col)))
    # no filter on the word count: it would be pushed below and split the text again
    starts = F.when(F.size("_words") > 0, F.sequence(F.lit(0), F.size("_words") - 1, F.lit(step)))
    placed = split.withColumn("_start", F.explode(starts))
    rest = [c for c in df.columns if c != text_col]
    return placed.select(
        *rest,
        (F.col("_start") / step).cast("int").alias("offset"),
        F.array_join(F.slice("_words", F.col("_start") + 1, F.lit(size)), " ").alias("chunk"),
    )


def document_id(key: Column, offset: Column) -> Column:
    return F.concat_ws("_", key, offset.cast("string"))


def document_rows(chunks: DataFrame) -> DataFrame:
    """Chunks keyed for storage; the page is named by its key, not by its URL."""
    return chunks.withColumn("id", document_id(F.col("url_key"), F.col("offset")))
