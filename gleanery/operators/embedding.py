"""Embedding a text column. The same embedder serves chunks and questions."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from gleanery.functions.text import words


class Embedder(Protocol):
    dim: int

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embed") -> DataFrame: ...


class HashedWords:
    """Offline default: L2-normalised hashed term frequencies, computed in the JVM."""

    def __init__(self, dim: int = 384):
        self.dim = dim

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embed") -> DataFrame:
        terms = df.withColumn("_terms", words(F.lower(text_col)))
        counted = HashingTF(numFeatures=self.dim, inputCol="_terms", outputCol="_tf").transform(terms)
        scaled = Normalizer(p=2.0, inputCol="_tf", outputCol="_unit").transform(counted)
        return scaled.withColumn(out_col, vector_to_array("_unit", "float32")).drop("_terms", "_tf", "_unit")


class BatchModel:
    """A sentence encoder run over Arrow batches, loaded once per Python worker.

    ``make_predict`` returns a function from an array of texts to an (n, dim) matrix.
    """

    def __init__(self, make_predict: Callable, dim: int, batch_size: int = 256):
        self.make_predict, self.dim, self.batch_size = make_predict, dim, batch_size

    def embed(self, df: DataFrame, text_col: str, out_col: str = "embed") -> DataFrame:
        predict = predict_batch_udf(
            self.make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size
        )
        return df.withColumn(out_col, predict(F.col(text_col)))


def embed_chunks(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    return embedder.embed(chunks, "chunk")


def embed_queries(queries: DataFrame, embedder: Embedder) -> DataFrame:
    return embedder.embed(queries, "prompt")
