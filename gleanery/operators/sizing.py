"""Broadcasting only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleanery.session import shared_dir

BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Rough size of a row in memory."""
    width = F.lit(32)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, T.ArrayType):
            narrow = isinstance(field.dataType.elementType, (T.FloatType, T.IntegerType))
            width = width + F.greatest(F.size(field.name), F.lit(0)) * (4 if narrow else 8) + 16
        else:
            width = width + 8
    return width


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows, written once to the shared folder, and their size in bytes."""
    shared_dir(df.sparkSession)
    kept = df.checkpoint()
    return kept, kept.agg(F.sum(row_bytes(kept).cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with a broadcast hint if they were measured to fit, else without."""
    kept, size = measured(df)
    return F.broadcast(kept) if size <= limit else kept
