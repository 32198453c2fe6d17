"""Explicit schemas of every message and table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "TIMESTAMP": T.TimestampType(),
    "ARRAY<FLOAT>": T.ArrayType(T.FloatType()),
}


def _struct(columns: str) -> T.StructType:
    """Nullable columns from "name TYPE, ..."; needs no session, unlike DDL parsing."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Where a record came from, in the order of its fields: the time it was taken down (of the
# record, or of its file) in microseconds, the partition or file, the offset or start of the
# part of the file.
ORIGIN = _struct("at BIGINT, name STRING, pos BIGINT")
# When an event arrived: by its number if it has one, else by its origin, and there by line.
ARRIVAL = T.StructType([T.StructField("seq", T.LongType()), *ORIGIN.fields, T.StructField("line", T.LongType())])
_TYPES["ARRIVAL"] = ARRIVAL

# Transport rows, whatever carried them (Kafka topic, envelope files, plain lines). Their
# reader adds an ORIGIN.
MESSAGE = _struct("key STRING, value STRING, seq BIGINT")

# JSON bodies. `seq` and `key` are only present in plain-line files.
PAGE_EVENT_JSON = _struct(
    "url STRING, timestamp BIGINT, html STRING, userId STRING, error STRING, seq BIGINT, key STRING"
)
CHAT_EVENT_JSON = _struct(
    "user_prompt STRING, model_response STRING, timestamp TIMESTAMP, seq BIGINT, key STRING"
)

CRAWL_REQUEST = _struct("url STRING, depth INT")
QUERY = _struct("qid STRING, prompt STRING, user_id STRING")

COMMIT = _struct("commit_id BIGINT")
# What a store's readers see: batches (or one bucket of them) that were added or dropped.
MANIFEST = _struct("change STRING, folder STRING, run BIGINT, batch_id BIGINT, bucket INT, buckets INT, commit_id BIGINT, at BIGINT")
# Tables kept in buckets by the hash of a column.
KEYS = {
    "page_snapshots": "url_key",
    "documents": "url_key",
    "crawl_log": "url_key",
    "conversations": "id",
    "ownership": "document_id",
}
# Keyed tables. `commit_id` orders the batches that wrote the rows.
TABLES: dict[str, T.StructType] = {
    "page_events": _struct(
        "ingest_seq BIGINT, arrival ARRIVAL, url_key STRING, url STRING, ts BIGINT, user_id STRING,"
        " n_words INT, text STRING, html STRING, reason STRING, value STRING"
    ),
    "page_snapshots": _struct(
        "url_key STRING, url STRING, ts BIGINT, html STRING, ingest_seq BIGINT, commit_id BIGINT"
    ),
    "crawl_log": _struct("url_key STRING, url STRING, ts BIGINT, commit_id BIGINT"),
    "documents": _struct(
        "id STRING, url_key STRING, chunk STRING, embed ARRAY<FLOAT>, offset INT, commit_id BIGINT"
    ),
    "ownership": _struct("document_id STRING, user_id STRING"),
    "conversations": _struct(
        "id STRING, user_prompt STRING, model_response STRING, timestamp TIMESTAMP,"
        " seq BIGINT, commit_id BIGINT"
    ),
    "page_dead_letter": _struct("value STRING, reason STRING"),
    "chat_dead_letter": _struct("value STRING, reason STRING"),
}
