"""Publishing, buckets, merging and expiry of the store's tables."""

from __future__ import annotations

import os
import random

import pytest

from gleanery.operators import messages as m
from gleanery.operators.embedding import HashedWords
from gleanery.plans.build_index import build_index
from gleanery.sources import store as stores
from gleanery.sources.store import Store
from gleanery.streaming.jobs import append_conversations
from tests.test_streams import MESSAGE, body, chat, page

EMBEDDER = HashedWords(4)
SNAPSHOT = "url_key string, url string, ts long, html string, ingest_seq long"
EVENT = [
    "ingest_seq", "struct(ingest_seq seq, 0L at, '' name, 0L pos, 0L line) arrival", "url_key", "url", "ts", "'u' user_id",
    "1 n_words", "'t' text", "html", "cast(null as string) reason", "cast(null as string) value",
]
VIEWS = ("documents", "documents_by_id", "snapshots", "crawl_log", "ownership", "conversations")


def shown(store) -> dict:
    """What every view shows, without the commit numbers that differ between stores."""
    frames = {name: getattr(store, name)() for name in VIEWS}
    frames["dead"] = store.read("page_dead_letter")
    return {name: sorted(str(r) for r in df.drop("commit_id", "embed", "ingest_seq").collect()) for name, df in frames.items()}


def batch(seed, n_pages=6):
    rng = random.Random(seed)
    rows = []
    for n in range(rng.randint(2, 6)):
        name = rng.randrange(n_pages)
        scheme = rng.choice(["http", "https"])
        rows.append((f"p{name}", page(f"{scheme}://p{name}", body(rng.choice([0, 3, 500, 900]), f"b{seed}x{n}y"), f"u{rng.randrange(3)}", seed * 10 + n), seed * 100 + n))
    return rows + [("z", f"broken {seed}", 1)]


def chats(seed):
    rng = random.Random(-seed)
    return [(f"c{rng.randrange(5)}", chat(f"{seed} {n}"), seed * 100 + n) for n in range(4)]


def add(spark, store, seed, run=1):
    build_index(m.parse_page_events(spark.createDataFrame(batch(seed), MESSAGE)), store, EMBEDDER, run, seed)
    append_conversations(m.parse_chat_events(spark.createDataFrame(chats(seed), MESSAGE)), store, run, seed)


def files(store, *skipped) -> list[str]:
    found = [os.path.join(d, f) for d, _, names in os.walk(store.root) for f in names if f.endswith((".parquet", ".json"))]
    return [f for f in found if not any(f"/{s}/" in f for s in skipped)]


@pytest.fixture
def pair(spark, tmp_path):
    """A store and one that is never merged."""
    return Store(spark, f"{tmp_path}/one", buckets=2), Store(spark, f"{tmp_path}/plain", buckets=2)


def test_a_batch_is_seen_whole_or_not_at_all(spark, pair, monkeypatch):
    store, plain = pair
    add(spark, store, 1)
    add(spark, plain, 1)
    before = shown(store)
    whole = Store.write
    for last in ("crawl_log", "page_snapshots"):

        def fails(self, table, rows, run, batch_id):
            whole(self, table, rows, run, batch_id)
            if table == last:
                raise RuntimeError("lost")

        monkeypatch.setattr(Store, "write", fails)
        with pytest.raises(RuntimeError, match="lost"):
            add(spark, store, 2)
        monkeypatch.setattr(Store, "write", whole)
        assert shown(store) == before
    add(spark, store, 2)
    add(spark, plain, 2)
    assert shown(store) == shown(plain) != before


def test_a_view_keeps_what_it_saw(spark, pair):
    store, _ = pair
    add(spark, store, 1)
    view, want = store.documents(), sorted(r.id for r in store.documents().collect())
    add(spark, store, 2)
    assert sorted(r.id for r in view.collect()) == want


def test_published_batches_are_not_written_again(spark, pair):
    store, _ = pair
    add(spark, store, 1)
    before, there = shown(store), files(store)
    build_index(m.parse_page_events(spark.createDataFrame(batch(9), MESSAGE)), store, EMBEDDER, 1, 1)
    append_conversations(m.parse_chat_events(spark.createDataFrame(chats(9), MESSAGE)), store, 1, 1)
    assert shown(store) == before and sorted(files(store)) == sorted(there)


def test_merging_and_expiry_change_no_view(spark, pair):
    store, plain = pair
    for seed in range(1, 5):
        add(spark, store, seed)
        add(spark, plain, seed)
        if seed == 2:
            store.merge(0)
            store.merge(1, ["page_snapshots"])
            store.expire(grace_seconds=0)
    assert shown(store) == shown(plain)
    for bucket in (0, 1):
        store.merge(bucket)
    store.expire(grace_seconds=0)
    assert shown(store) == shown(plain)
    assert store.read("page_snapshots").count() == plain.snapshots().count()
    before = files(store)
    store.merge(0)  # nothing is left to do
    assert files(store) == before
    # a replay of the last batch finds it done, also where the next reader is new
    again = Store(spark, store.root, buckets=2)
    add(spark, again, 4)
    assert files(again) == before
    add(spark, store, 5)
    add(spark, plain, 5)
    assert shown(store) == shown(plain)


def test_one_bucket_reads_only_itself(spark, pair):
    store, plain = pair
    for seed in (1, 2):
        add(spark, store, seed)
        add(spark, plain, seed)
    for view in ("documents", "snapshots", "crawl_log", "conversations"):
        parts = [getattr(store, view)(bucket=b).drop("commit_id") for b in (0, 1)]
        whole = getattr(plain, view)().drop("commit_id")
        assert sorted(map(str, parts[0].union(parts[1]).collect())) == sorted(map(str, whole.collect()))
    want = {view: sorted(map(str, getattr(store, view)(bucket=1).collect())) for view in ("documents", "snapshots", "conversations")}
    # files of the other bucket need not even be readable
    for file in files(store):
        if "/bucket=0/" in file:
            with open(file, "w") as lost:
                lost.write("not parquet")
    store.merge(1)
    assert len([x for x in store.live() if x[0] == "documents" and x[3] == 1]) == 1
    assert {view: sorted(map(str, getattr(store, view)(bucket=1).collect())) for view in want} == want
    with pytest.raises(Exception):
        store.snapshots(bucket=0).collect()


def test_batches_published_during_a_merge_stay(spark, pair, monkeypatch):
    store, plain = pair
    for seed in (1, 2):
        add(spark, store, seed)
        add(spark, plain, seed)
    whole, done = Store._record, []

    def between(self, name, changes):
        if name.startswith("merged") and not done:
            done.append(1)
            add(spark, Store(spark, store.root, buckets=2), 3)
        whole(self, name, changes)

    monkeypatch.setattr(Store, "_record", between)
    store.merge(0)
    add(spark, plain, 3)
    assert done and shown(store) == shown(plain)


def test_earlier_readers_are_given_time(spark, pair):
    store, _ = pair
    for seed in (1, 2):
        add(spark, store, seed)
    view, want = store.documents(), sorted(r.id for r in store.documents().collect())
    for bucket in (0, 1):
        store.merge(bucket)
    store.expire(grace_seconds=600)
    assert sorted(r.id for r in view.collect()) == want
    assert {x[2] for x in store.live() if x[0] == "page_events"} == {2} and store.read("page_events").count()
    store.expire(grace_seconds=0)
    assert not [f for f in files(store) if "/documents/run=1/" in f]
    assert sorted(r.id for r in store.documents().collect()) == want


def test_files_do_not_grow_with_the_batches(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store", buckets=2)
    counts = []
    for seed in range(1, 21):
        rows = spark.createDataFrame([("p", f"http://p?{seed % 2}", seed, f"html {seed}", seed)], SNAPSHOT).coalesce(1)
        store.write("page_snapshots", rows, 1, seed)
        store.write("page_events", rows.selectExpr(*EVENT), 1, seed)
        store.publish(1, seed, ["page_snapshots", "page_events"])
        if seed % 5 == 0:
            for bucket in (0, 1):
                store.merge(bucket)
            store.expire(grace_seconds=0)
            counts.append(len(files(store)))
    assert len(set(counts)) == 1 and counts[0] <= 6  # a bucket, the last events, the manifest, a commit
    assert store.read("page_events").count() == store.read("page_snapshots").count() == 1
    assert [r.html for r in store.snapshots().collect()] == ["html 20"]


def test_a_slower_clock_does_not_turn_back(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/store"
    for n, word in enumerate(("old", "new")):
        if n:
            monkeypatch.setattr(stores.time, "time_ns", lambda: 1_000_000_000)
        parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(1, word)), 1)], MESSAGE))
        build_index(parsed, Store(spark, root), EMBEDDER, 1, n)
    assert [r.chunk for r in Store(spark, root).documents().collect()] == ["new0"]


def test_a_store_keeps_its_buckets(spark, pair):
    store, _ = pair
    add(spark, store, 1)
    with pytest.raises(ValueError, match="has 2 buckets, not 8"):
        Store(spark, store.root).documents()
