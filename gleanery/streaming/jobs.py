"""The two streams. Both keep their offsets in a checkpoint and write each micro-batch
into its own folders, published as a whole, so a restart neither loses nor duplicates rows
and a reader sees all of a batch or nothing of it. Neither keeps
state between batches, so there is no watermark and no late data to drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators.embedding import Embedder
from gleanery.operators.messages import arrived, dead_letter, valid
from gleanery.plans.build_index import build_index
from gleanery.sources.store import Store


def append_conversations(parsed: DataFrame, store: Store, run: int, batch_id: int) -> None:
    """One micro-batch of chat events; of a repeated id the last arrival is kept. Both tables
    are published together; a batch that was published is left as it is."""
    if store.published("conversations", run, batch_id):
        return
    parsed = arrived(parsed, "seq").persist()  # a micro-batch, read for both tables; recomputed if lost
    try:
        good = valid(parsed)
        fields = [c for c in good.columns if c not in ("id", "origin", "arrival")]
        last = good.groupBy("id").agg(F.max_by(F.struct(*fields), "arrival").alias("row")).select("id", "row.*")
        store.write("conversations", last, run, batch_id)
        store.write("chat_dead_letter", dead_letter(parsed), run, batch_id)
        store.publish(run, batch_id, ["conversations", "chat_dead_letter"])
    finally:
        parsed.unpersist()


def _start(parsed: DataFrame, each, checkpoint: str, available_now: bool, interval: str | None) -> StreamingQuery:
    writer = parsed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def chat_stream(
    parsed: DataFrame,
    store: Store,
    checkpoint: str,
    run: int,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Chat events into the conversation table. ``run`` belongs to the checkpoint."""
    each = lambda batch, batch_id: append_conversations(batch, store, run, batch_id)
    return _start(parsed, each, checkpoint, available_now, interval)


def page_stream(
    parsed: DataFrame,
    store: Store,
    embedder: Embedder,
    checkpoint: str,
    run: int,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Page events into snapshots, crawl log, documents and ownership."""
    each = lambda batch, batch_id: build_index(batch, store, embedder, run, batch_id)
    return _start(parsed, each, checkpoint, available_now, interval)
