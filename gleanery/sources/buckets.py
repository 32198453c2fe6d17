"""Parquet tables kept in buckets by the hash of one column or several.

Rows of one value of the column lie in the files of one bucket, so a join on it reads them
where they are: only the other side is exchanged, whatever the size of either. The layout is
recorded beside the files, and any session can declare the table again from it; the
catalog's entry holds no data and may be lost.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gleanery.operators.sizing import row_bytes

BUCKET_BYTES = 256 << 20  # of rows in memory that one task reads
MOST_BUCKETS = 65_536

_LAYOUT = "by array<string>, buckets int, columns string"


def bucket_count(rows: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES``, a power of two so that tables of different size
    can meet without an exchange of the smaller one's buckets."""
    size = rows.agg(F.sum(row_bytes(rows).cast("bigint"))).first()[0] or 0
    buckets = 1
    while buckets * BUCKET_BYTES < size and buckets < MOST_BUCKETS:
        buckets *= 2
    return buckets


def write_bucketed(rows: DataFrame, folder: str, by: str | list[str], buckets: int, lasting: bool = True) -> DataFrame:
    """The rows, written to a new folder and read from it. They are exchanged once, by the
    hash of ``by``, so each bucket is one file. A table that is not ``lasting`` serves this
    session only and has no layout recorded."""
    spark, by = rows.sparkSession, [by] if isinstance(by, str) else by
    dealt = rows.repartition(buckets, *by)
    dealt.write.bucketBy(buckets, *by).format("parquet").option("path", folder).saveAsTable(_name(folder))
    if lasting:
        columns = ", ".join(f"{_quoted(f.name)} {_ddl(f.dataType)}" for f in rows.schema.fields)
        layout = spark.createDataFrame([(by, buckets, columns)], _LAYOUT)
        layout.coalesce(1).write.mode("overwrite").json(f"{folder}/_layout")
    return spark.table(_name(folder))


def read_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """A table written before, maybe by another session."""
    name = _name(folder)
    if not spark.catalog.tableExists(name):
        layout = spark.read.schema(_LAYOUT).json(f"{folder}/_layout").first()
        by = ", ".join(map(_quoted, layout["by"]))
        place = folder.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({layout['columns']}) USING parquet"
            f" CLUSTERED BY ({by}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{_ddl(kind.keyType)}, {_ddl(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"{_quoted(f.name)}: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    return kind.simpleString()


def _name(folder: str) -> str:
    return "bucketed_" + hashlib.md5(folder.rstrip("/").encode()).hexdigest()
