"""Last-write-wins state.

The newest write per key is found on narrow columns (keys and a long: a hash aggregate
with map-side combine, reading only those Parquet columns). Wide columns such as html or
vectors are then filtered, not grouped. Usually few keys were ever written twice; once
that list is measured to be small it is broadcast and the wide rows are not shuffled at
all. Otherwise they meet the newest writes in a semi-join on (key, order), which spreads
a page holding a third of all events over all tasks. Both ways give the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.functions.urls import url_key
from gleanery.operators.sizing import BROADCAST_BYTES, measured


def latest_by(
    rows: DataFrame,
    keys: list[str],
    order: str,
    versions: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows holding the greatest ``order`` of their key (one row, if orders are distinct).

    ``versions`` names the table whose writes count, by default the rows themselves; rows
    of a key it does not have, or of another order than its newest, are not shown. Null
    keys are one key, and a row without an order is never the latest.
    """
    columns = rows.columns
    extent = rows.groupBy(*keys).agg(
        F.min(order).alias("_oldest"), F.max(order).alias("_last"), F.count_if(F.col(order).isNull()).alias("_unordered")
    )
    if versions is None:
        judged = extent.withColumn("_newest", F.col("_last"))
    else:
        newest = versions.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(order).alias("_newest"))
        judged = extent.join(newest, _same(extent, newest, keys), "left")
    judged = judged.select(*[F.col(k).alias(f"_{k}") for k in keys], "_oldest", "_last", "_unordered", "_newest")
    settled = (F.col("_oldest") == F.col("_newest")) & (F.col("_last") == F.col("_newest")) & (F.col("_unordered") == 0)
    mixed = judged.where(~F.coalesce(settled, F.lit(False))).drop("_oldest", "_last", "_unordered")
    mixed, size = measured(mixed.withColumn("_mixed", F.lit(True)))
    if size <= broadcast_bytes:
        found = rows.join(F.broadcast(mixed), _same(rows, mixed, keys), "left")
        return found.where(F.col("_mixed").isNull() | (F.col(order) == F.col("_newest"))).select(*columns)
    return rows.join(judged, _same(rows, judged, keys) & (rows[order] == judged["_newest"]), "left_semi").select(*columns)


def _same(rows: DataFrame, other: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [rows[k].eqNullSafe(other[f"_{k}"]) for k in keys])


def keyed(events: DataFrame) -> DataFrame:
    return events.withColumn("url_key", url_key(F.col("url")))


def latest_snapshot(events: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Last arriving event per ``url_key``; event timestamps are not compared."""
    return latest_by(keyed(events), ["url_key"], order)


def crawl_log(events: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Per (url_key, url) the timestamp of its last arriving event; of several that arrived
    at once, the greatest. By ``arrival``, which no two events share, the log and the
    snapshot name the same capture."""
    last = F.max(F.struct(F.col(order).alias("order"), "ts")).alias("last")
    return keyed(events).groupBy("url_key", "url").agg(last).select("url_key", "url", "last.ts")


def latest_documents(documents: DataFrame, order: str = "commit_id") -> DataFrame:
    """Last write per document id."""
    return latest_by(documents, ["id"], order)
