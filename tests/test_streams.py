"""Messages, tables and streams."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.operators import messages as m
from gleanery.operators.embedding import HashedWords
from gleanery.plans.build_index import build_index, reindex
from gleanery.plans.migrate import import_pages
from gleanery.session import shared_dir
from gleanery.sources.messages import read_chat_events, read_messages, read_page_events, write_messages
from gleanery.sources.pages import export_crawl_log, read_crawl_logs, read_snapshots, write_page_folder
from gleanery.sources.store import Store
from gleanery.streaming.jobs import chat_stream, page_stream

EMBEDDER = HashedWords(16)
MESSAGE = "key string, value string, seq long"


def page(url, html, user="u", stamp=1, **more):
    return json.dumps({"url": url, "timestamp": stamp, "html": html, "userId": user, **more})


def body(n_words, word="w"):
    return "<body>" + " ".join(f"{word}{i}" for i in range(n_words)) + "</body>"


BAD_PAGES = {
    "malformed_json": ["{", "null", "not json", page("http://a", "h")[:-5], '{"url": "http://a", "timestamp": "soon", "html": "h", "userId": ""}'],
    "fetch_error": ['{"url": "http://a", "timestamp": 1, "error": "Failed", "userId": "u"}'],
    "missing_url": ["{}", '{"timestamp": 1, "html": "h", "userId": ""}'],
    "missing_timestamp": ['{"url": "http://a", "html": "h", "userId": ""}'],
    "missing_html": ['{"url": "http://a", "timestamp": 1, "userId": ""}'],
    "missing_userId": ['{"url": "http://a", "timestamp": 1, "html": "h"}'],
}


def test_page_event_verdicts(spark):
    rows = [("k", v, 1) for values in BAD_PAGES.values() for v in values]
    rows += [("k", page("http://ok", "h", user=""), 7), ("k", None, 8)]
    parsed = m.parse_page_events(spark.createDataFrame(rows, MESSAGE))
    bad = m.dead_letter(parsed).collect()
    assert {(r.reason, r.value) for r in bad} == {(reason, v) for reason, values in BAD_PAGES.items() for v in values}
    good = m.valid(parsed).collect()
    assert [(r.ingest_seq, r.url, r.ts, r.html, r.user_id) for r in good] == [(7, "http://ok", 1, "h", "")]


def chat(prompt, answer="a", stamp="2024-05-06 07:08:09.123456", **more):
    return json.dumps({"user_prompt": prompt, "model_response": answer, "timestamp": stamp, **more})


def test_chat_event_verdicts(spark):
    rows = [
        ("k1", chat("p"), 1),
        ("k2", chat("q", stamp="2024-05-06 07:08:09"), 2),
        (None, chat("r", stamp="whenever"), 3),
        ("k4", "oops", 4),
        ("k5", '{"other": 1}', 5),
        ("k6", None, 6),
    ]
    parsed = m.parse_chat_events(spark.createDataFrame(rows, MESSAGE))
    good = {r.user_prompt: r for r in m.valid(parsed).collect()}
    assert good["p"].id == "k1" and good["p"].timestamp == datetime(2024, 5, 6, 7, 8, 9, 123456)
    assert good["q"].timestamp == datetime(2024, 5, 6, 7, 8, 9)
    bad = {r.value: r.reason for r in m.dead_letter(parsed).collect()}
    assert bad["oops"] == "malformed_json" and bad['{"other": 1}'] == "missing_user_prompt"


def test_ids_do_not_change_on_replay(spark):
    rows = spark.createDataFrame([(None, chat("p"), 1), ("key", chat("p"), 2)], MESSAGE)
    ids = [[r.id for r in m.parse_chat_events(rows).orderBy("seq").collect()] for _ in range(2)]
    assert ids[0] == ids[1] and ids[0][1] == "key" and len(ids[0][0]) == 32


def test_page_events_survive_the_transport(spark, tmp_path):
    rows = [(3, "http://a.org/é", 5, 'quote " \\ \n <p>', "u"), (4, "https://a.org/é", 6, "", "")]
    events = spark.createDataFrame(rows, "ingest_seq long, url string, ts long, html string, user_id string")
    sent = m.page_event_messages(events)
    assert {r.key for r in sent.collect()} == {"a.org_é"}
    write_messages(sent, "envelope", f"{tmp_path}/topic")
    back = m.valid(read_page_events(spark, "envelope", f"{tmp_path}/topic"))
    assert {(r.ingest_seq, r.url, r.ts, r.html, r.user_id) for r in back.collect()} == set(rows)


def test_plain_lines_number_their_events(spark, tmp_path):
    lines = [page("http://a.org", f"<body>{n}</body>") for n in range(5)] + ["", "broken"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "pages.json").write_text("\n".join(lines))
    store = Store(spark, f"{tmp_path}/store")
    build_index(read_page_events(spark, "lines", f"{tmp_path}/in"), store, EMBEDDER, run=1)
    assert [r.html for r in store.snapshots().collect()] == ["<body>4</body>"]
    assert store.read("page_dead_letter").where("value = 'broken'").count() == 1


def test_unknown_transports_are_refused(spark):
    with pytest.raises(ValueError, match="unknown source"):
        read_messages(spark, "carrier pigeon", "x")
    with pytest.raises(ValueError, match="unknown sink"):
        write_messages(spark.createDataFrame([], MESSAGE), "carrier pigeon", "x")


@pytest.mark.parametrize("stream", [False, True])
def test_kafka_is_asked_for_by_name(spark, stream):
    """No connector is at hand: Spark itself must be what refuses, naming it."""
    servers = {"kafka__bootstrap__servers": "localhost:9092"}
    with pytest.raises(Exception, match="(?i)kafka"):
        read_page_events(spark, "kafka", "html", stream=stream, per_trigger=5, **servers)
    if not stream:
        with pytest.raises(Exception, match="(?i)kafka"):
            write_messages(spark.createDataFrame([], MESSAGE), "kafka", "html", **servers)


def test_stored_page_folder(spark, tmp_path):
    odd = "a.org_ü+%20 &=#1"
    (tmp_path / f"{odd}.html").write_text("<body>\n two\nlines</body>", encoding="utf-8")
    (tmp_path / "b.html").write_text("")
    (tmp_path / f"{odd}.log").write_text("url,timestamp\nhttp://x,5\nhttps://x,6\n")
    (tmp_path / "ignored.txt").write_text("no")
    pages = {r.url_key: r.html for r in read_snapshots(spark, str(tmp_path)).collect()}
    assert pages[odd] == "<body>\n two\nlines</body>"
    assert set(pages) - {odd} <= {"b"}
    log = read_crawl_logs(spark, str(tmp_path))
    assert {tuple(r) for r in log.collect()} == {(odd, "http://x", 5), (odd, "https://x", 6)}
    export_crawl_log(log, f"{tmp_path}/export")
    back = spark.read.option("header", True).csv(f"{tmp_path}/export")
    assert {tuple(r) for r in back.collect()} == {(odd, "http://x", "5"), (odd, "https://x", "6")}


def test_pages_are_stored_and_read_back(spark, tmp_path):
    folder = f"{tmp_path}/deep/folder"
    texts = {"a.org_ü+%20 &=#1": "\r\n<body>é\u2028\n</body>\r", "big": "x" * 3_000_000, "empty": "", "null": None, "n" * 250: "long name"}
    refused = {"_x": "1", ".y": "2", "n" * 251: "3", "ü" * 126: "4", "a/b": "5", "": "6", None: "7"}
    pages = spark.createDataFrame([*texts.items(), *refused.items()], "url_key string, html string").repartition(3)
    urls = [("big", f'http://big/{n}?q="a,b"\\{n}', n) for n in range(5000)] + [("a.org_ü+%20 &=#1", "http://ü", 7), ("_x", "http://x", 1)]
    log = spark.createDataFrame(urls, "url_key string, url string, ts bigint").repartition(4)
    for _ in range(2):  # written again, they are replaced
        lost, unlogged = write_page_folder(pages, log, folder)
    assert {r.url_key for r in lost.collect()} == set(refused) and [r.url_key for r in unlogged.collect()] == ["_x"]
    got = {r.url_key: r.html for r in read_snapshots(spark, folder).collect()}
    assert got == {k: v for k, v in texts.items() if v}
    assert sorted(tuple(r) for r in read_crawl_logs(spark, folder).collect()) == sorted(u for u in urls if u[0] != "_x")
    assert len(list((tmp_path / "deep" / "folder").iterdir())) == len(texts) + 2  # no drafts are left


def test_a_page_folder_is_taken_over(spark, tmp_path):
    pages = tmp_path / "html"
    pages.mkdir()
    (pages / "p.html").write_text(body(400))
    (pages / "q.html").write_text("<body>q</body>")
    (pages / "p.log").write_text("url,timestamp\nhttp://p,5\nhttps://p,6\n")
    store = Store(spark, f"{tmp_path}/store")
    import_pages(str(pages), store, run=1)
    rebuilt = reindex(store, EMBEDDER, "documents-1")
    assert ids(rebuilt.documents()) == ["p_0", "p_1", "q_0"]
    assert {(r.url_key, r.url, r.ts) for r in store.snapshots().collect()} == {("p", "https://p", 6), ("q", None, None)}
    assert store.crawl_log().count() == 2 and store.ownership().count() == 0

    # events arriving later replace the imported page
    parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(3)), 1)], MESSAGE))
    build_index(parsed, rebuilt, EMBEDDER, run=2)
    assert ids(rebuilt.documents()) == ["p_0", "q_0"]


def feed(folder, name, messages):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"key": k, "value": v, "seq": s}) for k, v, s in messages]
    (folder / name).write_text("\n".join(lines))


def run_pages(spark, topic, store, offsets):
    parsed = read_page_events(spark, "envelope", str(topic), stream=True, per_trigger=1)
    query = page_stream(parsed, store, EMBEDDER, str(offsets), run=1, available_now=True)
    query.awaitTermination()
    assert query.exception() is None


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_recrawls_replace_a_page_as_a_whole(spark, tmp_path):
    topic, store, offsets = tmp_path / "topic", Store(spark, f"{tmp_path}/store"), tmp_path / "offsets"
    feed(topic, "1.json", [("p", page("http://p", body(1000), "u"), 1), ("q", page("http://q", body(5), "v"), 2)])
    run_pages(spark, topic, store, offsets)
    assert ids(store.documents()) == ["p_0", "p_1", "p_2", "q_0"]

    # shrinks within one batch, last arrival wins; the superseded event's user keeps edges
    feed(topic, "2.json", [("p", page("http://p", body(10, "x"), "v"), 5), ("p", page("https://p", body(400, "y"), "w", 9), 4), ("z", "broken", 6)])
    run_pages(spark, topic, store, offsets)
    current = store.documents().collect()
    assert sorted(r.id for r in current) == ["p_0", "q_0"]
    assert next(r.chunk for r in current if r.id == "p_0").startswith("x0 x1")
    edges = {(r.document_id, r.user_id) for r in store.ownership().collect()}
    assert edges == {("p_0", "u"), ("p_1", "u"), ("p_2", "u"), ("q_0", "v"), ("p_0", "v"), ("p_0", "w"), ("p_1", "w")}
    assert {(r.url, r.ts) for r in store.crawl_log().collect()} == {("http://p", 1), ("https://p", 9), ("http://q", 1)}
    assert [r.value for r in store.read("page_dead_letter").collect()] == ["broken"]
    assert ids(store.documents_by_id()) == ["p_0", "p_1", "p_2", "q_0"]

    # a page left without words has no documents
    feed(topic, "3.json", [("q", page("http://q", "<body> </body>", "v"), 7)])
    run_pages(spark, topic, store, offsets)
    assert ids(store.documents()) == ["p_0"]

    # reindex keeps versions and adds no edges
    before = store.read("ownership").count()
    rebuilt = reindex(store, HashedWords(8), "documents-2")
    assert ids(rebuilt.documents()) == ["p_0"]
    assert {len(r.embed) for r in rebuilt.documents().collect()} == {8}
    assert store.read("ownership").count() == before
    assert {len(r.embed) for r in store.documents().collect()} == {16}

    # compaction keeps the views
    for table in ("page_snapshots", "documents", "ownership", "crawl_log"):
        store.compact(table, f"{table}-compact")
    compacted = Store(spark, store.root, **{t: f"{t}-compact" for t in ("page_snapshots", "documents", "ownership", "crawl_log")})
    assert ids(compacted.documents()) == ["p_0"]
    assert compacted.read("documents").count() == 1
    assert {(r.document_id, r.user_id) for r in compacted.ownership().collect()} == edges
    assert compacted.snapshots().count() == 2 and compacted.crawl_log().count() == 3


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(600)), 1)], MESSAGE))
    for _ in range(2):
        build_index(parsed, store, EMBEDDER, run=1, batch_id=3)
    assert {t: store.read(t).count() for t in ("page_events", "page_snapshots", "documents", "ownership", "crawl_log")} == {
        "page_events": 1, "page_snapshots": 1, "documents": 2, "ownership": 2, "crawl_log": 1,
    }
    before = store.read("documents").first().commit_id
    again = Store(spark, store.root)
    build_index(parsed, again, EMBEDDER, run=1, batch_id=3)
    assert {r.commit_id for r in again.read("documents").collect()} == {before} == {again.commit_id(1, 3)}


def test_one_snapshot_though_arrival_numbers_repeat(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    rows = [("p", page("http://p", body(3, word)), 5) for word in "abcd"] + [("q", page("http://q", body(2)), 5)]
    build_index(m.parse_page_events(spark.createDataFrame(rows, MESSAGE).repartition(3)), store, EMBEDDER, run=1)
    assert sorted(r.url_key for r in store.snapshots().collect()) == ["p", "q"]
    assert ids(store.documents()) == ["p_0", "q_0"]


def test_later_runs_win(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    for run, batch, word in ((1, 9, "old"), (2, 0, "new")):
        parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(3, word)), 1)], MESSAGE))
        build_index(parsed, store, EMBEDDER, run, batch)
    assert [r.chunk for r in store.documents().collect()] == ["new0 new1 new2"]


def test_a_running_stream_outlasts_a_backfill(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    for run, batch, word in ((1, 0, "first"), (2, 0, "backfill"), (1, 1, "last")):
        parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(3, word)), 1)], MESSAGE))
        build_index(parsed, Store(spark, store.root), EMBEDDER, run, batch)
    assert [r.chunk for r in store.documents().collect()] == ["last0 last1 last2"]


def test_views_survive_compaction_of_one_table(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    for batch, words in enumerate((1000, 1)):
        parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(words)), 1)], MESSAGE))
        build_index(parsed, store, EMBEDDER, 1, batch)
    for table in ("page_snapshots", "documents"):
        store.compact(table, f"{table}-compact")
        assert ids(Store(spark, store.root, **{table: f"{table}-compact"}).documents()) == ["p_0"]


def test_fetched_records_get_their_user(spark):
    body = json.dumps({"url": "http://p", "timestamp": 1, "html": "x"})
    rows = spark.createDataFrame([(None, body, None), ("k", page("http://p", "x", "own"), 7)], MESSAGE)
    assert [r.reason for r in m.parse_page_events(rows).orderBy("user_id").collect()] == ["missing_userId", None]
    assert [r.user_id for r in m.parse_page_events(rows, user="crawler").orderBy("user_id").collect()] == ["crawler", "own"]


def test_the_transport_comes_before_the_body(spark):
    body = json.dumps({"url": "http://p", "timestamp": 1, "html": "x", "userId": "u", "seq": 999})
    rows = spark.createDataFrame([("k", body, 3), (None, body, None)], MESSAGE)
    assert sorted(r.ingest_seq for r in m.parse_page_events(rows).collect()) == [3, 999]
    talk = json.dumps({"user_prompt": "a", "key": "body"})
    assert [r.id for r in m.parse_chat_events(spark.createDataFrame([("k", talk, 1), (None, talk, 2)], MESSAGE)).orderBy("seq").collect()] == ["k", "body"]


def test_wrong_vector_length_fails_the_write(spark, tmp_path):
    class Short(HashedWords):
        def embed(self, df, text_col, out_col="embed"):
            return df.withColumn(out_col, F.array(F.lit(1.0).cast("float")))

    parsed = m.parse_page_events(spark.createDataFrame([("p", page("http://p", body(3)), 1)], MESSAGE))
    with pytest.raises(Exception, match="expected 16 dimensions"):
        build_index(parsed, Store(spark, f"{tmp_path}/store"), Short(16), run=1)


def test_unread_tables_are_empty(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/nothing")
    assert store.documents().count() == store.conversations().count() == store.ownership().count() == 0


def test_chat_stream_restarts_without_loss_or_duplicates(spark, tmp_path):
    topic, store, offsets = tmp_path / "topic", Store(spark, f"{tmp_path}/store"), str(tmp_path / "offsets")

    def run():
        parsed = read_chat_events(spark, "envelope", str(topic), stream=True, per_trigger=1)
        chat_stream(parsed, store, offsets, run=1, available_now=True).awaitTermination()

    feed(topic, "1.json", [("a", chat("one"), 1), ("b", chat("two"), 2), ("b", chat("two again"), 3), ("c", "junk", 4)])
    run()
    feed(topic, "2.json", [("a", chat("one, repeated later"), 9), (None, chat("no key"), 10)])
    run()
    run()  # nothing new
    rows = {r.id: r.user_prompt for r in store.conversations().collect()}
    assert rows["a"] == "one, repeated later" and rows["b"] == "two again" and len(rows) == 3
    assert "no key" in rows.values()
    assert [r.value for r in store.read("chat_dead_letter").collect()] == ["junk"]
    store.compact("conversations", "conversations-compact")
    compacted = Store(spark, store.root, conversations="conversations-compact")
    assert {r.id: r.user_prompt for r in compacted.conversations().collect()} == rows
    assert compacted.read("conversations").count() == 3


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
