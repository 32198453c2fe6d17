"""Message transports: Kafka topics, or folders of JSON files standing in for them.

``envelope`` files hold one ``{"key", "value", "seq"}`` object per line, the columns a
topic record has; ``lines`` files hold bare bodies, such as a fetcher writes. Every message
says where it came from (``origin``: of a record its timestamp, partition and offset, of a
line its file's modification time, path and the part of it that was read), so that events
without a ``seq`` have an order that does not depend on how files are dealt to tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleanery import schemas
from gleanery.operators.messages import parse_chat_events, parse_page_events

def _origin(at: Column, name: Column, pos: Column) -> Column:
    return F.struct(at.alias("at"), name.alias("name"), pos.cast("bigint").alias("pos")).alias("origin")


def topic_messages(records: DataFrame) -> DataFrame:
    """Messages of a topic's records. Partitions are named so that they sort by number."""
    partition = F.lpad(F.col("partition").cast("string"), 10, "0")
    origin = _origin(F.unix_micros(F.col("timestamp").cast("timestamp")), partition, F.col("offset"))
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"), F.lit(None).cast("bigint").alias("seq"), origin)


def _file_origin() -> Column:
    changed = F.unix_micros("_metadata.file_modification_time")
    return _origin(changed, F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))


def read_messages(
    spark: SparkSession,
    source: str,
    location: str,
    stream: bool = False,
    starting: str = "earliest",
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """``key, value, seq, origin`` of a topic or folder. ``options`` go to the reader as they are
    (dots as ``__``, e.g. ``kafka__bootstrap__servers``); ``minPartitions`` splits a topic
    partition that a much-captured page has swollen."""
    reader = spark.readStream if stream else spark.read
    for name, value in options.items():
        reader = reader.option(name.replace("__", "."), value)
    if source == "kafka":
        if stream and per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        start = starting if stream else "earliest"
        return topic_messages(reader.format("kafka").option("subscribe", location).option("startingOffsets", start).load())
    if stream and per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if source == "envelope":
        return reader.schema(schemas.MESSAGE).json(location).select("*", _file_origin())
    if source == "lines":
        lines = reader.format("text").load(location)
        return lines.select(F.lit(None).cast("string").alias("key"), "value", F.lit(None).cast("bigint").alias("seq"), _file_origin())
    raise ValueError(f"unknown source {source!r}: kafka, envelope or lines")


def read_page_events(
    spark: SparkSession, source: str, location: str, stream: bool = False, user: str | None = None, **kw
) -> DataFrame:
    """Parsed page events from the earliest message on (with their ``reason``); ``user``
    is the contributor of records that name none."""
    return parse_page_events(read_messages(spark, source, location, stream, "earliest", **kw), user)


def read_chat_events(spark: SparkSession, source: str, location: str, stream: bool = False, **kw) -> DataFrame:
    """Parsed chat events, from the latest message on when streamed from a topic."""
    return parse_chat_events(read_messages(spark, source, location, stream, "latest", **kw))


def write_messages(messages: DataFrame, sink: str, location: str, **options: str) -> None:
    """Publish (key, value[, seq]) to a topic or append them to an envelope folder."""
    if sink == "kafka":
        writer = messages.select("key", "value").write.format("kafka").option("topic", location)
        for name, value in options.items():
            writer = writer.option(name.replace("__", "."), value)
        writer.save()
    elif sink == "envelope":
        messages.write.mode("append").json(location)
    else:
        raise ValueError(f"unknown sink {sink!r}: kafka or envelope")
