"""Inputs of the registered queries, derived by Spark from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleanery.operators.conversations import pair_turns
from gleanery.operators.embedding import HashedWords
from gleanery.operators.links import host_edges
from gleanery.operators.messages import page_event_messages, parse_page_events
from gleanery.plans.build_index import build_index
from gleanery.session import scratch_path, shared_dir
from gleanery.sources.store import Store

EMBEDDER = HashedWords(384)
TEMPLATE = "Context:\n{}\n\nQuestion:\n{}\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_events(spark, sf_dir) -> DataFrame:
    """Each page as one capture. Arrival order is the page id; timestamps are shuffled
    against it. The contributor is the language segment of the URL."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ingest_seq"),
        "url",
        (F.lit(1704067200000) + (F.col("page_id") * 7919) % 1000003 * 1000).alias("ts"),
        "html",
        F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1).alias("user_id"),
    )


def recrawl_events(spark, sf_dir) -> DataFrame:
    """The same captures filed under their site section, so that pages of a section
    replace each other and http/https twins share a key."""
    section = F.regexp_extract("url", "^https?://[^/]+/[a-z]+", 0)
    return page_events(spark, sf_dir).withColumn("url", section)


def page_messages(events: DataFrame) -> DataFrame:
    """Transport messages in which captures cut off before ``</body>`` went wrong:
    the message of one with a query string in its URL is cut in half, one with a
    fragment reports a fetch error, any other lost its user."""
    whole = page_event_messages(events)
    joined = events.join(whole.withColumnRenamed("seq", "ingest_seq"), "ingest_seq")
    cut_off = ~F.col("html").contains("</body>")
    failed = F.to_json(F.struct("url", F.col("ts").alias("timestamp"), F.lit("Failed").alias("error")))
    anonymous = F.to_json(F.struct("url", F.col("ts").alias("timestamp"), "html"))
    value = (
        F.when(cut_off & F.col("url").contains("?"), F.substr("value", F.lit(1), (F.length("value") / 2).cast("int")))
        .when(cut_off & F.col("url").contains("#"), failed)
        .when(cut_off, anonymous)
        .otherwise(F.col("value"))
    )
    return joined.select("key", value.alias("value"), F.col("ingest_seq").alias("seq"))


def chat_events(spark, sf_dir) -> DataFrame:
    pairs = pair_turns(table(spark, sf_dir, "conversations"))
    return pairs.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "user_prompt",
        "model_response",
        F.timestamp_micros(F.lit(1704067200000000) + F.col("conv_id") * 60000123 + F.col("turn")).alias("timestamp"),
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("seq"),
    )


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("embed")
    )


def vector_queries(spark, sf_dir, scoped: bool = False) -> DataFrame:
    """Every vector as a question. Scoped: label 0 asks about everything, the rest
    each about what the user of the same number owns."""
    rows = table(spark, sf_dir, "embeddings")
    user = F.when(F.col("label") == 0, "").otherwise(F.col("vec_id").cast("string"))
    return rows.select(
        F.col("vec_id").cast("string").alias("qid"),
        (user if scoped else F.lit("")).alias("user_id"),
        F.col("embedding").alias("embed"),
    )


def vector_ownership(spark, sf_dir) -> DataFrame:
    """Events as edges from their user to the vector numbered event_id modulo all."""
    n = table(spark, sf_dir, "embeddings").count()
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") % n).cast("string").alias("document_id"), F.col("user_id").cast("string").alias("user_id")
    )


def questions(spark, sf_dir) -> DataFrame:
    """Every turn as a prompt: users ask within a language (by conversation number),
    other roles ask nothing; every fifth conversation searches all data."""
    langs = F.array(*[F.lit(v) for v in ("", "en", "fr", "de", "es")])
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("qid"),
        F.when(F.col("role") == "user", F.col("text")).otherwise("").alias("prompt"),
        F.element_at(langs, (F.col("conv_id") % 5 + 1).cast("int")).alias("user_id"),
    )


def linked_site(spark, sf_dir) -> DataFrame:
    """Captured pages whose links lead somewhere: the table's pages, and for each link
    target on their host a page linking back to the first page that names it."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    back = host_edges(pages).groupBy("target").agg(F.min("url").alias("back"))
    link = F.concat(F.lit("<a href='"), F.replace("back", F.lit("&"), F.lit("&amp;")), F.lit("'>back</a><a href='#'>top</a>"))
    shared_dir(spark)
    return pages.unionByName(back.select(F.col("target").alias("url"), link.alias("html"))).checkpoint()


_indexes: dict[tuple, Store] = {}


def index(spark: SparkSession, sf_dir: str, fresh: bool = False, whole: bool = False) -> Store:
    """The index over the section captures, or over all pages as they are (``whole``),
    built once per session and table folder."""
    at = (spark.sparkContext.applicationId, sf_dir, whole)
    if fresh or at not in _indexes:
        store = Store(spark, scratch_path(spark, "index"))
        messages = page_event_messages(page_events(spark, sf_dir)) if whole else page_messages(recrawl_events(spark, sf_dir))
        build_index(parse_page_events(messages), store, EMBEDDER, run=1)
        _indexes[at] = store
    return _indexes[at]
