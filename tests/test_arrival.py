"""The order in which events arrived, whatever carried them."""

from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gleanery.operators import messages as m
from gleanery.operators.keyed import crawl_log, latest_snapshot
from gleanery.plans.build_index import build_index
from gleanery.sources.messages import read_chat_events, read_page_events, topic_messages
from gleanery.sources.store import Store
from gleanery.streaming.jobs import append_conversations, page_stream
from tests.test_streams import EMBEDDER, MESSAGE, body, chat, page

RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
NOON = datetime(2024, 5, 6, 12, tzinfo=timezone.utc)


def records(spark, rows):
    """Topic records (partition, offset, seconds after noon, value), in any order."""
    full = [(b"k", v.encode(), "html", p, o, NOON + timedelta(seconds=s), 1) for p, o, s, v in rows]
    random.Random(1).shuffle(full)
    return spark.createDataFrame(full, RECORD).repartition(4)


def snapshots(spark, folder, parsed):
    store = Store(spark, str(folder))
    build_index(parsed, store, EMBEDDER, run=1)
    return store


@pytest.mark.parametrize(
    "rows,last",
    [
        # a partition far ahead of another holds older records
        ([(0, 9_000_000, 5, "old"), (1, 3, 60, "new")], "new"),
        # within a partition and a moment the offset counts
        ([(2, n, 7, f"n{n}") for n in range(40)], "n39"),
        # partition numbers beyond fourteen bits, and ones that sort differently as text
        ([(9, 1, 7, "nine"), (40_000, 1, 7, "forty thousand")], "forty thousand"),
        ([(16_384, 1, 7, "other"), (0, 2, 7, "least partition")], "other"),
    ],
)
def test_topics_of_several_partitions(spark, tmp_path, rows, last):
    parsed = m.parse_page_events(topic_messages(records(spark, [(p, o, s, page("http://p", v, stamp=o)) for p, o, s, v in rows])))
    store = snapshots(spark, tmp_path, parsed)
    assert [r.html for r in store.snapshots().collect()] == [last]


def test_chat_events_of_several_partitions(spark, tmp_path):
    rows = [(3, 900, 1, chat("old")), (1, 2, 30, chat("new")), (7, 1, 20, chat("middle"))]
    store = Store(spark, str(tmp_path))
    append_conversations(m.parse_chat_events(topic_messages(records(spark, rows))), store, 1, 0)
    assert [(r.id, r.user_prompt) for r in store.conversations().collect()] == [("k", "new")]


def write(folder, name, lines, at):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))
    os.utime(folder / name, (at, at))


def test_files_of_different_sizes(spark, tmp_path):
    """Readers deal large files first; the order is that of the files' times all the same."""
    folder = tmp_path / "in"
    write(folder, "b.json", [page("http://p", body(2000, "old"))] * 30 + [page("http://q", "q old")], 1000)
    write(folder, "a.json", [page("http://p", "newest"), page("http://q", "q1"), page("http://q", "q2")], 3000)
    write(folder, "c.json", [page("http://p", body(900, "middle"))] * 20, 2000)
    store = snapshots(spark, tmp_path / "store", read_page_events(spark, "lines", str(folder)))
    assert {r.url_key: r.html for r in store.snapshots().collect()} == {"p": "newest", "q": "q2"}


def test_files_of_one_moment_go_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "2.json", [page("http://p", "two")], 1000)
    write(folder, "1.json", [page("http://p", body(500, "one"))] * 9, 1000)
    store = snapshots(spark, tmp_path / "store", read_page_events(spark, "lines", str(folder)))
    assert [r.html for r in store.snapshots().collect()] == ["two"]


def test_lines_of_a_file_read_in_parts(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "one.json", [page(f"http://p{n % 7}", f"line {n} " + "x" * (n % 50)) for n in range(3000)], 1000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        parsed = read_page_events(spark, "lines", str(folder))
        assert parsed.rdd.getNumPartitions() > 4
        store = snapshots(spark, tmp_path / "store", parsed)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {f"p{n % 7}": n for n in range(3000)}
    assert {r.url_key: int(r.html.split()[1]) for r in store.snapshots().collect()} == want


def test_numbers_come_before_places(spark, tmp_path):
    """Numbered events are newer than all that have none, and go by number."""
    folder = tmp_path / "in"
    write(folder, "a.json", [json.dumps({"key": "p", "value": page("http://p", f"n{n}"), "seq": n}) for n in (5, 9, 7)], 1000)
    write(folder, "b.json", [json.dumps({"key": "p", "value": page("http://p", "none")})], 9000)
    store = snapshots(spark, tmp_path / "store", read_page_events(spark, "envelope", str(folder)))
    assert [r.html for r in store.snapshots().collect()] == ["n9"]


def test_log_and_snapshot_name_the_same_capture(spark, tmp_path):
    """Also where arrival numbers repeat, or are missing."""
    rows = [("p", page("http://p", f"h{n}", stamp=(n * 37) % 101), 5) for n in range(60)]
    rows += [("q", page("http://q", f"h{n}", stamp=(n * 53) % 97), None) for n in range(60)]
    store = snapshots(spark, tmp_path, m.parse_page_events(spark.createDataFrame(rows, MESSAGE).repartition(5)))
    both = store.snapshots().join(store.crawl_log().withColumnRenamed("ts", "logged"), ["url_key", "url"])
    assert both.count() == 2 and both.where("ts = logged").count() == 2


def test_ties_by_number_alone_have_one_answer(spark):
    rows = [(5, "http://p", ts, "x") for ts in (3, 9, 4)]
    events = spark.createDataFrame(rows, "ingest_seq long, url string, ts long, html string").repartition(3)
    assert [r.ts for r in crawl_log(events).collect()] == [9]
    assert latest_snapshot(m.arrived(events.withColumn("origin", F.lit(None).cast("struct<at:bigint,name:string,pos:bigint>")), "ingest_seq"), "arrival").count() == 1


def test_a_stream_of_lines(spark, tmp_path):
    """Files of one micro-batch, the newest of them the smallest."""
    folder, store = tmp_path / "in", Store(spark, f"{tmp_path}/store")
    write(folder, "a.json", [page("http://p", body(1500, "old"))] * 20, 1000)
    write(folder, "b.json", [page("http://p", "first"), page("http://p", "last")], 2000)
    parsed = read_page_events(spark, "lines", str(folder), stream=True)
    page_stream(parsed, store, EMBEDDER, f"{tmp_path}/offsets", run=1, available_now=True).awaitTermination()
    assert [r.html for r in store.snapshots().collect()] == ["last"]


def test_chat_lines_without_numbers(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.json", [chat("old " * 400, key="k")] * 5, 1000)
    write(folder, "b.json", [chat("first", key="k"), chat("last", key="k")], 2000)
    store = Store(spark, f"{tmp_path}/store")
    append_conversations(read_chat_events(spark, "lines", str(folder)), store, 1, 0)
    assert [(r.id, r.user_prompt) for r in store.conversations().collect()] == [("k", "last")]
