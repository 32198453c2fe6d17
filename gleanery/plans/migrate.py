"""Taking over a folder of stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.sources.pages import read_crawl_logs, read_snapshots
from gleanery.sources.store import Store


def import_pages(folder: str, store: Store, run: int) -> None:
    """Stored pages and their crawl logs as one batch of the store's tables. A page's URL
    is the one its log names last. Follow with ``reindex`` to derive the documents; as the
    files name no user, there are no ownership edges."""
    logs = read_crawl_logs(store.spark, folder)
    store.write("crawl_log", logs, run, 0)
    newest = store.read_batch("crawl_log", run, 0).groupBy("url_key").agg(
        F.max_by("url", "ts").alias("url"), F.max("ts").alias("ts")
    )
    pages = read_snapshots(store.spark, folder).join(newest, "url_key", "left")
    store.write("page_snapshots", pages.withColumn("ingest_seq", F.lit(0).cast("bigint")), run, 0)
    store.publish(run, 0, ["crawl_log", "page_snapshots"])
