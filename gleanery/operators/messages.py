"""Parsing and vetting of transport messages, and their inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleanery import schemas
from gleanery.functions.urls import url_key

_CORRUPT = "_corrupt"


def _decoded(messages: DataFrame, body: T.StructType) -> DataFrame:
    """``data`` = the JSON body; null values are skipped, as an empty poll is."""
    schema = T.StructType([*body.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    origin = F.col("origin") if "origin" in messages.columns else F.lit(None)
    return messages.where(F.col("value").isNotNull()).select(
        "key", "value", "seq", origin.cast(schemas.ORIGIN).alias("origin"), F.from_json("value", schema, options).alias("data")
    )


def _first_problem(checks: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, name in checks])


def parse_page_events(messages: DataFrame, user: str | None = None) -> DataFrame:
    """Page events with a ``reason`` column, NULL on good rows. ``user`` is stamped on
    records that name none, as those of a fetcher do not."""
    data = _decoded(messages, schemas.PAGE_EVENT_JSON)
    user_id = F.coalesce(F.col("data.userId"), F.lit(user).cast("string"))
    field = lambda name: F.col(f"data.{name}")
    reason = _first_problem(
        [
            (F.col("data").isNull() | field(_CORRUPT).isNotNull(), "malformed_json"),
            (field("html").isNull() & field("error").isNotNull(), "fetch_error"),
            (field("url").isNull(), "missing_url"),
            (field("timestamp").isNull(), "missing_timestamp"),
            (field("html").isNull(), "missing_html"),
            (user_id.isNull(), "missing_userId"),
        ]
    )
    return data.select(
        F.coalesce("seq", "data.seq").alias("ingest_seq"),  # the transport's word comes first
        field("url").alias("url"),
        field("timestamp").alias("ts"),
        field("html").alias("html"),
        user_id.alias("user_id"),
        "origin",
        "value",
        reason.alias("reason"),
    )


def parse_chat_events(messages: DataFrame) -> DataFrame:
    """Chat events with a ``reason`` column, NULL on good rows.

    The id is the message key, which the producer draws once per event, so a replayed
    micro-batch yields the same ids; without a key it is a digest of the body.
    """
    data = _decoded(messages, schemas.CHAT_EVENT_JSON)
    reason = _first_problem(
        [
            (F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull(), "malformed_json"),
            (F.col("data.user_prompt").isNull(), "missing_user_prompt"),
        ]
    )
    return data.select(
        event_id(F.coalesce("key", "data.key"), F.col("value")).alias("id"),
        "data.user_prompt",
        "data.model_response",
        "data.timestamp",
        F.coalesce("seq", "data.seq").alias("seq"),
        "origin",
        "value",
        reason.alias("reason"),
    )


def event_id(key: Column, value: Column) -> Column:
    return F.coalesce(key, F.md5(value))


def arrived(parsed: DataFrame, number: str) -> DataFrame:
    """Events with ``arrival``, by which all of a batch are ordered (batches only).

    A number given by the transport or the body comes first; events without one are older
    than all that have one. Equal or missing numbers are told apart by the origin: for a
    topic the record's timestamp, its partition and offset, for files the modification time,
    the path and the part of the file that was read. Within that part the line counts,
    however Spark deals the parts to its tasks. A topic whose timestamps are the broker's
    own (``LogAppendTime``) is so in the order of its offsets within a partition."""
    origin = [F.coalesce(F.col("origin.at"), F.lit(0)), F.coalesce(F.col("origin.name"), F.lit("")), F.coalesce(F.col("origin.pos"), F.lit(0))]
    first = F.coalesce(F.col(number), F.lit(-(1 << 63)))
    arrival = F.struct(first, *origin, F.monotonically_increasing_id()).cast(schemas.ARRIVAL)
    return parsed.withColumn("arrival", arrival)


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("value", "reason")


def dead_letter(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def non_empty(queries: DataFrame) -> DataFrame:
    """Questions with a prompt; an empty one is not answered."""
    return queries.where(F.length("prompt") > 0)


def page_event_messages(events: DataFrame) -> DataFrame:
    """(key, value[, seq]) of page events ``url, ts, html, user_id``.

    Keyed by ``url_key``, so a page's events share a partition and keep their order.
    """
    body = F.struct("url", F.col("ts").alias("timestamp"), "html", F.col("user_id").alias("userId"))
    return _messages(events, url_key(F.col("url")), body)


def chat_event_messages(events: DataFrame) -> DataFrame:
    """(key, value[, seq]) of chat events ``user_prompt, model_response, timestamp[, id]``.

    Give an ``id`` where a retried write must not look like a new event.
    """
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    body = F.struct("user_prompt", "model_response", stamp)
    key = F.col("id") if "id" in events.columns else F.uuid()
    return _messages(events, key, body)


def _messages(events: DataFrame, key: Column, body: Column) -> DataFrame:
    value = F.to_json(body, {"ignoreNullFields": "false"})
    seq = [F.col(c).cast("bigint").alias("seq") for c in ("ingest_seq", "seq") if c in events.columns]
    return events.select(key.alias("key"), value.alias("value"), *seq[:1])
