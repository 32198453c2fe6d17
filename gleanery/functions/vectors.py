"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays, in double."""
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)


def checked_vector(embed: Column, dim: int) -> Column:
    """The vector itself, failing the write when it has the wrong length."""
    problem = F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(embed).cast("string"))
    return F.when(F.size(embed) == dim, embed).otherwise(F.raise_error(problem))
