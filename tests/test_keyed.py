"""Last-write-wins state and ownership."""

from __future__ import annotations

import random

import pytest

from gleanery.operators.keyed import crawl_log, latest_by, latest_documents, latest_snapshot
from gleanery.operators.ownership import documents_for_user, ownership_edges

EVENT = "ingest_seq long, url string, ts long, html string"
EVENTS = [
    (1, "http://a.org/x", 50, "first"),
    (2, "https://a.org/x", 10, "twin"),
    (3, "http://a.org/x", 40, "older stamp, later arrival"),
    (4, "http://a.org_x", 5, "underscore"),
    (5, "http://b.org", 1, "once"),
]


@pytest.mark.parametrize("seed", range(3))
def test_last_arrival_wins_in_any_order(spark, seed):
    rows = random.Random(seed).sample(EVENTS, len(EVENTS))
    got = latest_snapshot(spark.createDataFrame(rows, EVENT)).collect()
    assert {(r.url_key, r.html) for r in got} == {("a.org_x", "underscore"), ("b.org", "once")}


def test_crawl_log_keeps_colliding_urls_apart(spark):
    got = crawl_log(spark.createDataFrame(EVENTS, EVENT)).collect()
    assert {(r.url_key, r.url, r.ts) for r in got} == {
        ("a.org_x", "http://a.org/x", 40),
        ("a.org_x", "https://a.org/x", 10),
        ("a.org_x", "http://a.org_x", 5),
        ("b.org", "http://b.org", 1),
    }


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_both_ways_of_picking_the_latest_agree(spark, limit):
    rows = [(f"k{n % 7}", n, "x" * n) for n in range(50)] + [("hot", n, "y") for n in range(100, 150)]
    df = spark.createDataFrame(rows, "k string, n long, wide string")
    got = {(r.k, r.n) for r in latest_by(df, ["k"], "n", broadcast_bytes=limit).collect()}
    assert got == {(k, max(n for kk, n, _ in rows if kk == k)) for k, _, _ in rows}


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_both_ways_agree_on_nulls_and_versions(spark, limit):
    rows = [(None, 1), (None, 2), ("a", None), ("b", 1), ("b", 2), ("c", 1), ("d", 5), ("e", None), ("e", 1)]
    df = spark.createDataFrame(rows, "k string, n long")
    assert {tuple(r) for r in latest_by(df, ["k"], "n", broadcast_bytes=limit).collect()} == {(None, 2), ("b", 2), ("c", 1), ("d", 5), ("e", 1)}
    versions = spark.createDataFrame([(None, 1), ("b", 2), ("c", 9), ("e", 1)], "k string, n long")
    got = latest_by(df, ["k"], "n", versions=versions, broadcast_bytes=limit).collect()
    assert {tuple(r) for r in got} == {(None, 1), ("b", 2), ("e", 1)}


def test_wide_rows_are_not_shuffled_when_few_keys_repeat(spark):
    df = spark.range(1000).selectExpr("cast(id as string) k", "id n", "'wide' w")
    plan = latest_by(df, ["k"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_latest_documents_keep_stale_trailing_chunks(spark):
    rows = [("p_0", 1, "old"), ("p_1", 1, "old"), ("p_0", 2, "new")]
    got = latest_documents(spark.createDataFrame(rows, "id string, commit_id long, chunk string")).collect()
    assert {(r.id, r.chunk) for r in got} == {("p_0", "new"), ("p_1", "old")}


def test_edges_are_the_union_over_events(spark):
    texts = [("p", "u", 1000), ("p", "u", 10), ("p", "v", 385), ("q", "u", 0)]
    got = ownership_edges(spark.createDataFrame(texts, "url_key string, user_id string, n_words int")).collect()
    assert sorted((r.document_id, r.user_id) for r in got) == [
        ("p_0", "u"), ("p_0", "v"), ("p_1", "u"), ("p_1", "v"), ("p_2", "u"),
    ]


def test_documents_for_user(spark):
    docs = spark.createDataFrame([("p_0",), ("p_1",), ("q_0",)], "id string")
    edges = spark.createDataFrame([("p_0", "u"), ("p_0", "u"), ("gone_0", "u"), ("q_0", "v")], "document_id string, user_id string")
    assert [r.id for r in documents_for_user(docs, edges, "u").collect()] == ["p_0"]
    assert documents_for_user(docs, edges, "nobody").count() == 0
