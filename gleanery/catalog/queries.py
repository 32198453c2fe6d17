"""One entry per operator: (spark, table folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanery.catalog import inputs as i
from gleanery.functions.html import extract_text
from gleanery.functions.text import clean_text
from gleanery.functions.urls import url_host, url_key
from gleanery.functions.vectors import squared_l2
from gleanery.operators import messages as m
from gleanery.operators.chunks import chunk_words, document_rows
from gleanery.operators.context import answer_block, assemble_context, evidence
from gleanery.operators.conversations import pair_turns, truncate_to_last_user
from gleanery.operators.embedding import embed_chunks, embed_queries
from gleanery.operators.keyed import crawl_log, latest_documents, latest_snapshot
from gleanery.operators.links import (
    crawl_frontier,
    crawl_reach,
    extract_links,
    extract_urls,
    resolve_links,
    same_host,
    valid_depth,
)
from gleanery.operators.ownership import documents_for_user, ownership_edges
from gleanery.operators.topk import nearest
from gleanery.plans.build_index import build_index, page_texts, reindex
from gleanery.plans.crawl import crawl_plan
from gleanery.plans.migrate import import_pages
from gleanery.plans.retrieve import prompts, retrieve
from gleanery.session import scratch_path
from gleanery.sources.messages import read_chat_events, read_page_events, write_messages
from gleanery.sources.pages import write_page_folder
from gleanery.sources.store import Store
from gleanery.streaming.jobs import append_conversations, chat_stream, page_stream

QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _weights(embedded: DataFrame, key: str) -> DataFrame:
    """A vector as its non-zero entries."""
    entries = embedded.select(key, F.posexplode("embed").alias("bucket", "weight"))
    return entries.where(F.col("weight") != 0)


def _pages(spark, sf_dir):
    return i.table(spark, sf_dir, "pages")


# expressions


@query
def extract_urls_from_messages(spark, sf_dir):
    url, host = F.col("url"), url_host(F.col("url"))
    text = F.concat(
        F.lit("Index "), url, F.lit(", <"), url, F.lit('> and "'), url, F.lit('"; also (www.'), host, F.lit("/x.) thanks")
    )
    return extract_urls(_pages(spark, sf_dir).select("page_id", text.alias("text")), "text")


@query
def url_keys(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", url_key(F.col("url")).alias("url_key"))


@query
def url_hosts(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", url_host(F.col("url")).alias("host"))


@query
def extract_page_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", extract_text(F.col("html")).alias("text"))


@query
def clean_document_text(spark, sf_dir):
    noisy = F.concat(
        F.lit("\t \\t"), F.col("text"), F.lit(" ["), F.col("doc_id").cast("string"), F.lit("] \\n\\n "),
        F.replace("text", F.lit(" "), F.lit(" \n ")), F.lit("[7][x] "),
    )
    return i.table(spark, sf_dir, "documents").select("doc_id", clean_text(noisy).alias("text"))


@query
def chunk_documents(spark, sf_dir):
    return chunk_words(i.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def embed_document_chunks(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url_key"), "text")
    return _weights(embed_chunks(document_rows(chunk_words(docs)), i.EMBEDDER), "id")


@query
def embed_questions(spark, sf_dir):
    return _weights(embed_queries(m.non_empty(i.questions(spark, sf_dir)), i.EMBEDDER), "qid")


@query
def page_document_rows(spark, sf_dir):
    texts = page_texts(i.page_events(spark, sf_dir)).select("url_key", "text")
    return document_rows(chunk_words(texts)).select("id", "url_key", "offset", "chunk")


@query
def chat_event_ids(spark, sf_dir):
    sent = m.chat_event_messages(i.chat_events(spark, sf_dir))
    keyed = m.parse_chat_events(sent).select("seq", "id")
    unkeyed = m.parse_chat_events(sent.withColumn("key", F.lit(None).cast("string")))
    return keyed.join(unkeyed.select("seq", F.col("id").alias("digest")), "seq")


# links


@query
def page_links(spark, sf_dir):
    return extract_links(_pages(spark, sf_dir)).select("page_id", "pos", "href")


@query
def resolved_page_links(spark, sf_dir):
    return resolve_links(extract_links(_pages(spark, sf_dir))).select("page_id", "pos", "target")


@query
def same_host_links(spark, sf_dir):
    links = resolve_links(extract_links(i.linked_site(spark, sf_dir)))
    return same_host(links.withColumn("host", url_host(F.col("url")))).select("url", "pos", "target")


@query
def crawl_reach_depth_4(spark, sf_dir):
    seeds = _pages(spark, sf_dir).select("url", F.lit(4).alias("depth"))
    return crawl_reach(i.linked_site(spark, sf_dir), seeds)


@query
def crawl_frontier_depth_1(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    reach = crawl_reach(pages, pages.select("url", F.lit(1).alias("depth")))
    return crawl_frontier(pages, reach)


@query
def crawl_plans(spark, sf_dir):
    """Seeds from user text, reached pages and frontier, as one list of steps."""
    texts = i.page_events(spark, sf_dir).select(
        F.concat(F.lit("Please read "), F.col("url"), F.lit(" first")).alias("text"),
        F.when(F.col("user_id") == "en", 0).when(F.col("user_id") == "fr", 1).otherwise(2).alias("depth"),
    )
    plan = crawl_plan(texts, i.linked_site(spark, sf_dir))
    none = F.lit(None)
    return (
        plan.seeds.select(F.lit("seed").alias("step"), F.col("url").alias("seed"), "url", none.cast("string").alias("target"), "depth")
        .unionByName(plan.reach.select(F.lit("reach").alias("step"), "seed", "url", none.cast("string").alias("target"), "depth"))
        .unionByName(plan.frontier.select(F.lit("fetch").alias("step"), "seed", "url", "target", "depth"))
    )


@query
def crawl_fetches(spark, sf_dir):
    """What a fetcher is to fetch when only every page's section was asked for, which is
    not captured, beside the pages of one language."""
    events = i.page_events(spark, sf_dir)
    section = F.regexp_extract("url", "^https?://[^/]+/[a-z]+", 0)
    texts = events.select(F.concat_ws(" ", section, F.when(F.col("user_id") == "de", F.col("url"))).alias("text"), F.lit(2).alias("depth"))
    return crawl_plan(texts, events.select("url", "html")).fetches


@query
def entity_links(spark, sf_dir):
    """Links whose query names parameters like references, beside real references."""
    tail = "&region=eu&section=2&copy=3&not&copy;&#38;x=1&amp;y=2"
    html = F.concat(F.lit('<p><a href="/s?a='), "page_id", F.lit(tail + '">x</a>'))
    return extract_links(_pages(spark, sf_dir).select("page_id", html.alias("html"))).select("page_id", "pos", "href")


# filters


@query
def judged_page_events(spark, sf_dir):
    parsed = m.parse_page_events(i.page_messages(i.page_events(spark, sf_dir)))
    return parsed.select("ingest_seq", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query
def fetched_records(spark, sf_dir):
    """Pages as a fetcher reports them, without a user, and every third one with its own."""
    own = F.when(F.col("page_id") % 3 == 0, F.col("url"))
    value = F.to_json(F.struct("url", F.col("page_id").alias("timestamp"), "html", own.alias("userId")))
    lines = _pages(spark, sf_dir).select(F.lit(None).cast("string").alias("key"), value.alias("value"), F.lit(None).cast("bigint").alias("seq"))
    return m.parse_page_events(lines, user="crawler").select("url", "ts", "user_id", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query
def judged_chat_events(spark, sf_dir):
    """Turns as chat messages in which only user turns carry a prompt, and system
    turns are not JSON at all."""
    body = F.to_json(F.struct(F.when(F.col("role") == "user", F.col("text")).alias("user_prompt"), F.lit("x").alias("model_response")))
    turns = i.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("key"),
        F.when(F.col("role") == "system", F.concat(F.lit("{"), "text")).otherwise(body).alias("value"),
        F.col("turn").alias("seq"),
    )
    parsed = m.parse_chat_events(turns)
    return parsed.select("id", "user_prompt", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query
def non_empty_questions(spark, sf_dir):
    return m.non_empty(i.questions(spark, sf_dir))


@query
def valid_crawl_requests(spark, sf_dir):
    """Depth is the page number in the URL minus one, where there is one."""
    number = F.nullif(F.regexp_extract("url", r"[?&]page=(\d+)", 1), F.lit(""))
    good, bad = valid_depth(_pages(spark, sf_dir).select("url", (number.try_cast("int") - 1).alias("depth")))
    rejected = bad.select(F.get_json_object("value", "$.url").alias("url"), F.lit(None).cast("int").alias("depth"), "reason")
    return good.withColumn("reason", F.lit("ok")).unionByName(rejected)


# last-write-wins


@query
def latest_page_snapshots(spark, sf_dir):
    return latest_snapshot(i.recrawl_events(spark, sf_dir)).select("url_key", "url", "ts", "html")


@query
def page_crawl_log(spark, sf_dir):
    return crawl_log(i.recrawl_events(spark, sf_dir))


@query
def latest_documents_by_id(spark, sf_dir):
    texts = page_texts(i.recrawl_events(spark, sf_dir)).select("url_key", "ingest_seq", "text")
    rows = document_rows(chunk_words(texts))
    return latest_documents(rows, "ingest_seq").select("id", "offset", "chunk")


@query
def ownership_of_pages(spark, sf_dir):
    return ownership_edges(page_texts(i.recrawl_events(spark, sf_dir)))


# retrieval on given vectors


@query
def vector_gaps(spark, sf_dir):
    """Distance of each vector to its successor."""
    rows = i.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("after"))
    return rows.join(after, "vec_id").select("vec_id", squared_l2(F.col("embedding"), F.col("after")).alias("dist"))


@query
def user_vectors(spark, sf_dir):
    mine = documents_for_user(i.vectors(spark, sf_dir), i.vector_ownership(spark, sf_dir), "8")
    return mine.select("id")


@query
def nearest_vectors(spark, sf_dir):
    return nearest(i.vector_queries(spark, sf_dir), i.vectors(spark, sf_dir))


@query
def nearest_owned_vectors(spark, sf_dir):
    asked = i.vector_queries(spark, sf_dir, scoped=True)
    return nearest(asked, i.vectors(spark, sf_dir), ownership=i.vector_ownership(spark, sf_dir))


def _document_hits(spark, sf_dir):
    """Scoped hits with the document of the same number as their chunk."""
    docs = i.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.col("source").alias("url_key"),
        F.col("text").alias("chunk"),
    )
    return nearest_owned_vectors(spark, sf_dir).join(docs, "document_id")


def _vector_prompts(spark, sf_dir):
    return i.vector_queries(spark, sf_dir).select("qid", F.concat(F.lit("What about "), "qid", F.lit("?")).alias("prompt"))


@query
def assembled_contexts(spark, sf_dir):
    return assemble_context(_document_hits(spark, sf_dir), _vector_prompts(spark, sf_dir), i.TEMPLATE)


@query
def hit_evidence(spark, sf_dir):
    return evidence(_document_hits(spark, sf_dir))


@query
def answer_blocks(spark, sf_dir):
    answers = _vector_prompts(spark, sf_dir).select("qid", F.upper("prompt").alias("answer"))
    return answer_block(answers, evidence(_document_hits(spark, sf_dir)))


# conversations


@query
def paired_turns(spark, sf_dir):
    return pair_turns(i.table(spark, sf_dir, "conversations"))


@query
def paired_turns_short_spans(spark, sf_dir):
    """The same pairs with every conversation held to be long, in spans so short that
    most pairs cross a border."""
    return pair_turns(i.table(spark, sf_dir, "conversations"), long=0, span=2)


@query
def turns_to_last_user(spark, sf_dir):
    return truncate_to_last_user(i.table(spark, sf_dir, "conversations"))


# transports, tables and streams


@query
def page_event_transport(spark, sf_dir):
    """Page events published and read back."""
    folder = scratch_path(spark, "html-topic")
    write_messages(m.page_event_messages(i.page_events(spark, sf_dir)), "envelope", folder)
    return m.valid(read_page_events(spark, "envelope", folder)).drop("origin")


@query
def imported_pages(spark, sf_dir):
    """Every page's latest capture and crawl log as a folder of files, taken over by a store:
    pages under the URL that their log names last, with the number of URLs it names."""
    events = i.page_events(spark, sf_dir).withColumn("html", F.concat(F.lit("\n"), "html", F.lit("\r\nü\n")))
    folder, store = scratch_path(spark, "stored"), Store(spark, scratch_path(spark, "index"))
    write_page_folder(latest_snapshot(events), crawl_log(events), folder)
    import_pages(folder, store, run=1)
    urls = store.crawl_log().groupBy("url_key").agg(F.count("*").alias("urls"))
    return store.snapshots().join(urls, "url_key").select("url_key", "url", "ts", "html", "urls")


@query
def unnumbered_captures(spark, sf_dir):
    """Three deliveries of captures as plain lines without arrival numbers, the first in the
    largest files and the second in the smallest: snapshots with the time logged for them.
    Within a delivery a section's captures are lines of one file, by page number."""
    folder, store = scratch_path(spark, "captures"), Store(spark, scratch_path(spark, "index"))
    for n, (every, filler) in enumerate(((1, 400), (5, 0), (3, 40))):
        events = i.recrawl_events(spark, sf_dir).where(F.col("ingest_seq") % every == 0)
        text = F.concat(F.lit(f"<body>delivery {n} of "), "ingest_seq", F.repeat(F.lit(" filler"), filler), F.lit("</body>"))
        body = F.struct("url", F.col("ts").alias("timestamp"), text.alias("html"), F.lit("crawler").alias("userId"))
        lines = events.select("url", "ingest_seq", F.to_json(body).alias("value"))
        lines = lines.repartition(4, url_key(F.col("url"))).sortWithinPartitions("ingest_seq")
        lines.select("value").write.mode("append").text(folder)
    build_index(read_page_events(spark, "lines", folder), store, i.EMBEDDER, run=1)
    newest = store.snapshots().select("url_key", "url", "ts", F.substring_index("html", " ", 4).alias("html"))
    return newest.join(store.crawl_log().withColumnRenamed("ts", "logged"), ["url_key", "url"])


@query
def chat_event_transport(spark, sf_dir):
    folder = scratch_path(spark, "chat-topic")
    write_messages(m.chat_event_messages(i.chat_events(spark, sf_dir)), "envelope", folder)
    events = m.valid(read_chat_events(spark, "envelope", folder))
    return events.select("id", "user_prompt", "model_response", F.unix_micros("timestamp").alias("micros"), "seq")


@query
def stored_conversations(spark, sf_dir):
    """Chat events appended in two batches, the second repeating the first."""
    store = Store(spark, scratch_path(spark, "chats"))
    parsed = m.parse_chat_events(m.chat_event_messages(i.chat_events(spark, sf_dir)))
    append_conversations(parsed, store, 1, 0)
    append_conversations(parsed, store, 1, 1)
    rows = store.conversations()
    return rows.select("id", "user_prompt", "model_response", F.unix_micros("timestamp").alias("micros"))


@query
def streamed_conversations(spark, sf_dir):
    folder, store = scratch_path(spark, "chat-topic"), Store(spark, scratch_path(spark, "chats"))
    write_messages(m.chat_event_messages(i.chat_events(spark, sf_dir)), "envelope", folder)
    parsed = read_chat_events(spark, "envelope", folder, stream=True)
    chat_stream(parsed, store, scratch_path(spark, "offsets"), run=1, available_now=True).awaitTermination()
    rows = store.conversations()
    return rows.select("id", "user_prompt", "model_response", F.unix_micros("timestamp").alias("micros"))


@query
def streamed_documents(spark, sf_dir):
    folder, store = scratch_path(spark, "html-topic"), Store(spark, scratch_path(spark, "index"))
    write_messages(i.page_messages(i.recrawl_events(spark, sf_dir)), "envelope", folder)
    parsed = read_page_events(spark, "envelope", folder, stream=True)
    page_stream(parsed, store, i.EMBEDDER, scratch_path(spark, "offsets"), run=1, available_now=True).awaitTermination()
    return store.documents().select("id", "url_key", "offset", "chunk")


@query
def indexed_documents(spark, sf_dir):
    return i.index(spark, sf_dir, fresh=True).documents().select("id", "url_key", "offset", "chunk")


@query
def indexed_ownership(spark, sf_dir):
    return i.index(spark, sf_dir).ownership()


@query
def indexed_snapshots(spark, sf_dir):
    return i.index(spark, sf_dir).snapshots().select("url_key", "url", "ts", "html")


@query
def indexed_crawl_log(spark, sf_dir):
    return i.index(spark, sf_dir).crawl_log()


@query
def interleaved_runs_documents(spark, sf_dir):
    """Three writes of every page: a stream, a backfill under a later run, and the stream
    again, which arrives last."""
    store = Store(spark, scratch_path(spark, "interleaved"))
    for n, (run, batch) in enumerate(((1, 0), (2, 0), (1, 1))):
        events = i.page_events(spark, sf_dir).withColumn("html", F.concat(F.lit(f"<body>write {n} of "), "ingest_seq", F.lit("</body>")))
        build_index(m.parse_page_events(m.page_event_messages(events)), store, i.EMBEDDER, run, batch)
    return store.documents().select("id", "chunk")


@query
def compacted_snapshots_documents(spark, sf_dir):
    """Documents after pages shrank and the snapshots alone were compacted."""
    store = Store(spark, scratch_path(spark, "compacted"))
    for batch, words in enumerate((600, 1)):
        body = F.concat(F.lit("<body>"), F.repeat(F.lit("w "), words - 1), "ingest_seq", F.lit("</body>"))
        events = i.page_events(spark, sf_dir).withColumn("html", body)
        build_index(m.parse_page_events(m.page_event_messages(events)), store, i.EMBEDDER, 1, batch)
    store.compact("page_snapshots", "page_snapshots-compact")
    return Store(spark, store.root, page_snapshots="page_snapshots-compact").documents().select("id", "chunk")


@query
def merged_buckets_documents(spark, sf_dir):
    """Documents after pages grew and shrank over three batches, with every bucket merged
    after the second and everything superseded deleted."""
    store = Store(spark, scratch_path(spark, "merged"), buckets=4)
    for batch, words in enumerate((600, 900, 1)):
        body = F.concat(F.lit("<body>"), F.repeat(F.lit("w "), words - 1), "ingest_seq", F.lit("</body>"))
        events = i.page_events(spark, sf_dir).where(F.col("ingest_seq") % (batch + 1) == 0).withColumn("html", body)
        build_index(m.parse_page_events(m.page_event_messages(events)), store, i.EMBEDDER, 1, batch)
        if batch == 1:
            for bucket in range(store.buckets):
                store.merge(bucket)
            store.expire(grace_seconds=0)
    return store.documents().select("id", F.substring_index("chunk", " ", -1).alias("last_word"))


@query
def reindexed_documents(spark, sf_dir):
    store = i.index(spark, sf_dir)
    rebuilt = reindex(store, i.EMBEDDER, scratch_path(spark, "documents").rsplit("/", 1)[1])
    return rebuilt.documents().select("id", "url_key", "offset", "chunk")


@query
def retrieved_hits(spark, sf_dir):
    store = i.index(spark, sf_dir, whole=True)
    return retrieve(i.questions(spark, sf_dir), store.documents(), store.ownership(), i.EMBEDDER)


@query
def retrieval_prompts(spark, sf_dir):
    store = i.index(spark, sf_dir, whole=True)
    return prompts(i.questions(spark, sf_dir), store.documents(), store.ownership(), i.EMBEDDER, i.TEMPLATE)


@query
def served_hits(spark, sf_dir):
    """The same hits from documents kept in buckets: owners and hits meet them there, as if
    there were too many of either to be broadcast, and questions are asked in parts."""
    store = i.index(spark, sf_dir, whole=True)
    folder = scratch_path(spark, "served").rsplit("/", 1)[1]
    documents = store.serve_documents(folder, buckets=8)
    bounds = {"broadcast_bytes": 4 << 20, "owner_bytes": 0, "few_hits": 0}
    return retrieve(i.questions(spark, sf_dir), documents, store.ownership(), i.EMBEDDER, **bounds)
