"""From page events to snapshots, crawl log, documents and ownership."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanery.functions.html import extract_text
from gleanery.functions.text import clean_text, words
from gleanery.functions.urls import url_key
from gleanery.operators.chunks import chunk_words, document_rows
from gleanery.operators.embedding import Embedder, embed_chunks
from gleanery.operators.messages import arrived, dead_letter
from gleanery.operators.keyed import crawl_log, latest_by
from gleanery.operators.ownership import ownership_edges
from gleanery.sources.store import Store

TABLES = ("page_events", "page_dead_letter", "crawl_log", "ownership", "documents", "page_snapshots")


def page_texts(events: DataFrame) -> DataFrame:
    """Events with their ``url_key``, cleaned ``text`` and ``n_words``."""
    texts = events.withColumn("url_key", url_key(F.col("url"))).withColumn("raw", extract_text(F.col("html")))
    texts = texts.withColumn("text", clean_text(F.col("raw")))
    return texts.withColumn("n_words", F.size(words(F.col("text")))).drop("raw")


def documents_of(texts: DataFrame, embedder: Embedder) -> DataFrame:
    """Embedded document rows of ``url_key, text`` (other columns pass through)."""
    return document_rows(embed_chunks(chunk_words(texts), embedder))


def build_index(parsed: DataFrame, store: Store, embedder: Embedder, run: int, batch_id: int = 0) -> None:
    """Index one batch of parsed page events (a whole table or one micro-batch).

    The events are vetted, parsed and written once; everything else is derived from
    that table, each step reading only its columns. So no step recomputes the Python
    extraction and nothing large is cached. All tables of the batch are published together
    at the end; a batch that was published is left as it is.
    """
    if store.published("page_events", run, batch_id):
        return
    vetted = page_texts(arrived(parsed, "ingest_seq"))  # the order is fixed by the first write
    broken = F.when(F.col("html").isNotNull() & F.col("text").isNull(), "unparsable_html")
    vetted = vetted.withColumn("reason", F.coalesce("reason", broken)).withColumn(
        "value", F.when(F.col("reason").isNotNull(), F.col("value"))
    )
    store.write("page_events", vetted, run, batch_id)

    events = store.read_batch("page_events", run, batch_id)
    store.write("page_dead_letter", dead_letter(events), run, batch_id)
    good = events.where(F.col("reason").isNull())
    store.write("crawl_log", crawl_log(good, "arrival"), run, batch_id)
    # every event's user gets edges, also when a later event replaced the page
    store.append_ownership(ownership_edges(good), run, batch_id)
    latest = latest_by(good, ["url_key"], "arrival")
    store.upsert_documents(documents_of(latest.select("url_key", "text"), embedder), embedder.dim, run, batch_id)
    store.write("page_snapshots", latest, run, batch_id)
    store.publish(run, batch_id, TABLES)


def reindex(store: Store, embedder: Embedder, folder: str, run: int = 0) -> Store:
    """Rebuild every stored page's documents into a new folder and return a store that
    reads it. Snapshot versions are kept; no ownership edges are written."""
    pages = store.snapshots().select("url_key", "html", "commit_id")
    texts = pages.select("url_key", "commit_id", clean_text(extract_text(F.col("html"))).alias("text"))
    rebuilt = store.renamed(documents=folder)
    rebuilt.upsert_documents(documents_of(texts, embedder), embedder.dim, run, 0)
    rebuilt.publish(run, 0, ["documents"])
    return rebuilt
