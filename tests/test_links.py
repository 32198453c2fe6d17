"""Link graph against a recursive model."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gleanery.operators.links import (
    _dealt,
    _stepped,
    crawl_frontier,
    crawl_reach,
    extract_urls,
    host_edges,
    same_host,
    valid_depth,
)
from gleanery.plans.crawl import crawl_plan
from gleanery.sources.buckets import write_bucketed

A = "http://a.org"
SITE = {
    f"{A}/": ["/1", "/2", "#x", "mailto:m@a.org", "rel.html", "http://b.org/"],
    f"{A}/1": ["/3", "/1", "//A.org/2", "/missing"],
    f"{A}/2": ["/3", "http://A.ORG/3", "http:///bad", "http://a.org:8080/4"],
    f"{A}/3": ["/", "/5"],
    f"{A}:8080/4": ["/4", "//a.org/5"],
    f"{A}/5": ["/é"],
    f"{A}/%C3%A9": [],
    "http://b.org/": ["/only", "http://a.org/1", "http://sub.b.org/"],
    "http://b.org/only": ["/"],
    "http://sub.b.org/": [],
}
# what each link means, by hand
TARGETS = {
    f"{A}/": [f"{A}/1", f"{A}/2"],
    f"{A}/1": [f"{A}/3", f"{A}/1", f"{A}/2", f"{A}/missing"],
    f"{A}/2": [f"{A}/3", "http://A.ORG/3", f"{A}:8080/4"],
    f"{A}/3": [f"{A}/", f"{A}/5"],
    f"{A}:8080/4": [f"{A}:8080/4", f"{A}/5"],
    f"{A}/5": [f"{A}/%C3%A9"],
    f"{A}/%C3%A9": [],
    "http://b.org/": ["http://b.org/only"],
    "http://b.org/only": ["http://b.org/"],
    "http://sub.b.org/": [],
}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(url, "".join(f'<a href="{h}">x</a>' for h in links)) for url, links in SITE.items()]
    return spark.createDataFrame(rows, "url string, html string").cache()


def walk(url, depth, limit, found):
    """The fetcher's recursion: every visit, least depth kept."""
    if depth > limit or url not in TARGETS:
        return found
    found[url] = min(depth, found.get(url, depth))
    for target in TARGETS[url]:
        walk(target, depth + 1, limit, found)
    return found


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 6])
def test_reach_equals_the_recursion(spark, pages, depth):
    seeds = [f"{A}/", "http://b.org/", "http://nowhere.org/", "http://sub.b.org/"]
    got = crawl_reach(pages, spark.createDataFrame([(s, depth) for s in seeds], "url string, depth int"))
    rows = got.collect()
    assert len(rows) == len({(r.seed, r.url) for r in rows})
    want = {(s, u): d for s in seeds for u, d in walk(s, 1, depth, {}).items()}
    assert {(r.seed, r.url): r.depth for r in rows} == want


def test_reach_grows_with_depth_and_seeds_keep_their_own(spark, pages):
    seeds = spark.createDataFrame([(f"{A}/", 2), ("http://b.org/", 1), (f"{A}/3", 3), (f"{A}/", 1)], "url string, depth int")
    got = {(r.seed, r.url): r.depth for r in crawl_reach(pages, seeds).collect()}
    want = {}
    for seed, depth in ((f"{A}/", 2), ("http://b.org/", 1), (f"{A}/3", 3)):
        want |= {(seed, u): d for u, d in walk(seed, 1, depth, {}).items()}
    assert got == want


def test_frontier(spark, pages):
    reach = crawl_reach(pages, spark.createDataFrame([(f"{A}/", 2)], "url string, depth int"))
    got = {(r.seed, r.url, r.target, r.depth) for r in crawl_frontier(pages, reach).collect()}
    assert got == {(f"{A}/", f"{A}/1", f"{A}/missing", 3), (f"{A}/", f"{A}/2", "http://A.ORG/3", 3)}


def test_same_host_is_exact(spark):
    links = spark.createDataFrame(
        [("http://a.org/x",), ("https://A.org:1/x",), ("http://www.a.org/x",), ("http:///x",)], "target string"
    )
    kept = same_host(links.withColumn("host", F.lit("a.org"))).collect()
    assert {r.target for r in kept} == {"http://a.org/x", "https://A.org:1/x"}


def test_valid_depth(spark):
    requests = [("http://a.org", 1), ("http://a.org", 0), ("http://a.org", None), ("www.a.org", 2), ("http://a.org", -3)]
    good, bad = valid_depth(spark.createDataFrame(requests, "url string, depth int"))
    assert [(r.url, r.depth) for r in good.collect()] == [("http://a.org", 1)]
    assert sorted(r.reason for r in bad.collect()) == ["invalid_depth"] * 3 + ["invalid_url"]


def test_extract_urls_keeps_order(spark):
    df = spark.createDataFrame([("u", "b http://b.org a http://a.org http://b.org")], "user_id string, text string")
    got = [(r.user_id, r.pos, r.url) for r in extract_urls(df, "text").orderBy("pos").collect()]
    assert got == [("u", 0, "http://b.org"), ("u", 1, "http://a.org"), ("u", 2, "http://b.org")]


def test_fetches_start_with_uncaptured_seeds(spark, pages):
    requests = spark.createDataFrame([(f"{A}/1 and http://new.org/x", 2)], "text string, depth int")
    got = {(r.seed, r.url, r.target, r.depth) for r in crawl_plan(requests, pages).fetches.collect()}
    assert got == {("http://new.org/x", None, "http://new.org/x", 1), (f"{A}/1", f"{A}/1", f"{A}/missing", 2)}


def test_crawl_plan(spark, pages):
    requests = spark.createDataFrame(
        [(f"start at {A}/ please", 2), (f"also {A}/ and www.nohost.org/", 1), ("http://b.org/", 0)], "text string, depth int"
    )
    plan = crawl_plan(requests, pages)
    assert [(r.url, r.depth) for r in plan.seeds.collect()] == [(f"{A}/", 2)]
    assert {r.url for r in plan.reach.collect()} == set(walk(f"{A}/", 1, 2, {}))
    assert plan.frontier.count() == 2
    assert plan.fetches.count() == 0  # those lie beyond the depth asked for
    assert sorted(r.reason for r in plan.dead_letter.collect()) == ["invalid_depth", "invalid_url"]


def _walks(seeds):
    return {(s, u): d for s, depth in seeds.items() for u, d in walk(s, 1, depth, {}).items()}


@pytest.mark.parametrize("hub,hot", [(1, 1), (2, 100)])
def test_reach_over_edges_in_buckets(spark, pages, hub, hot):
    seeds = {f"{A}/": 4, "http://b.org/": 2, f"{A}/3": 4, f"{A}:8080/4": 3, "http://nowhere.org/": 4}
    rows = crawl_reach(pages, spark.createDataFrame(list(seeds.items()), "url string, depth int"), 0, hub, hot).collect()
    assert len(rows) == len({(r.seed, r.url) for r in rows})
    assert {(r.seed, r.url): r.depth for r in rows} == _walks(seeds)


def test_no_round_exchanges_the_edges(spark, pages, tmp_path):
    edges = host_edges(pages).distinct()
    steps, fans = _dealt(edges, 2, 8)
    assert {r.url: r.fan for r in fans.collect()} == {f"{A}/1": 2, f"{A}/2": 2}
    standing = spark.createDataFrame([(f"{A}/", f"{A}/1", 3, 2), (f"{A}/3", f"{A}/3", 3, 1)], "seed string, url string, max_depth int, fan int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ahead = _stepped(standing, steps, 100)
        text = ahead._jdf.queryExecution().executedPlan().toString()
        assert ahead.count() == len(TARGETS[f"{A}/1"]) + len(TARGETS[f"{A}/3"])
        reached = write_bucketed(standing.select("seed", "url"), str(tmp_path / "reached"), ["seed", "url"], 8)
        rest = ahead.groupBy("seed", "url").agg(F.max("max_depth")).join(reached, ["seed", "url"], "left_anti")
        anti = rest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert scans_exchanged(text, "target") == 0 and text.count("Exchange hashpartitioning") == 1
    assert anti.count("Exchange hashpartitioning(seed") == 1  # what was reached is not


def scans_exchanged(text, column):
    """File scans of the column with an exchange right above them, up to the next join."""
    lines = text.split("\n")
    scans = [n for n, line in enumerate(lines) if "FileScan" in line and column in line]
    return sum("Exchange" in line for n in scans for line in lines[max(0, n - 3) : n])
