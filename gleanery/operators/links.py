"""Link graph of captured pages: extraction, bounded same-host reach, frontier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.functions.html import hrefs, unescape_html
from gleanery.functions.text import urls_in
from gleanery.functions.urls import url_host, with_target
from gleanery.operators.sizing import BROADCAST_BYTES, broadcast_if_small, measured
from gleanery.session import scratch_path, shared_dir
from gleanery.sources.buckets import write_bucketed

HUB = 65_536  # links of a page that lie in one bucket
HOT = 1_000_000  # walks on one page that are not exchanged


def extract_urls(df: DataFrame, text_col: str) -> DataFrame:
    """One row per URL found in the text, in order of appearance."""
    rest = [c for c in df.columns if c != text_col]
    return df.select(*rest, F.posexplode(urls_in(F.col(text_col))).alias("pos", "url"))


def extract_links(pages: DataFrame) -> DataFrame:
    """Every ``a[href]`` of a page: the page's columns but html, ``pos`` and ``href``."""
    rest = [c for c in pages.columns if c != "html"]
    found = pages.select(*rest, F.posexplode(hrefs(F.col("html"))).alias("pos", "raw"))
    return found.select(*rest, "pos", unescape_html(F.col("raw")).alias("href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Links that can be followed, with their ``target``."""
    return with_target(links)


def same_host(links: DataFrame, host: str = "host") -> DataFrame:
    """Links whose target has exactly the given host column's name (no subdomains)."""
    return links.where(url_host(F.col("target")) == F.col(host))


def valid_depth(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable requests, dead letter): depth must be a number >= 1, the URL have a host."""
    reason = F.when(F.col("depth").isNull() | (F.col("depth") < 1), "invalid_depth").when(
        url_host(F.col("url")).isNull(), "invalid_url"
    )
    judged = requests.withColumn("reason", reason)
    good = judged.where(F.col("reason").isNull()).drop("reason")
    bad = judged.where(F.col("reason").isNotNull())
    return good, bad.select(F.to_json(F.struct("url", "depth")).alias("value"), "reason")


def on_hosts_of(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pages on some seed's host. A walk never leaves it, so no other page is parsed."""
    hosts = broadcast_if_small(seeds.select(url_host(F.col("url")).alias("host")).distinct())
    placed = pages.withColumn("host", url_host(F.col("url")))
    return placed.join(hosts, "host", "left_semi").select("url", "html", "host")


def host_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of links staying on their page's host, without repeats in a page.

    A walk keeps to its seed's host, so every page it stands on has that host: links
    leaving the page's own host can be dropped before any walk starts. Repeats are dropped
    inside the page's row, so the edges of all pages need no shuffle.
    """
    # exploding the expression, not a column holding it, keeps the optimizer from adding a
    # "not empty" filter that would extract the links a second time
    found = F.explode(F.array_distinct(hrefs(F.col("html"))))
    links = pages.select("url", url_host(F.col("url")).alias("host"), found.alias("raw"))
    decoded = links.select("url", "host", unescape_html(F.col("raw")).alias("href"))
    return same_host(resolve_links(decoded)).select("url", "target")


def crawl_reach(
    pages: DataFrame, seeds: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hub: int = HUB, hot: int = HOT
) -> DataFrame:
    """``seed, url, depth``: captured pages within each seed's depth, at least depth.

    Breadth-first over edges between captured pages: a round joins the current frontier
    with the edges and removes what was reached. Edges measured to take ``broadcast_bytes``
    at most are broadcast. More of them are kept in buckets by their page, those of a page
    with over ``hub`` links in several parts, and are exchanged in no round: the frontier
    comes to them. Where over ``hot`` walks stand on one page, its edges go to the walks.
    Beside edges in buckets, what was reached lies in buckets too, by walk and page, and
    stays there. Each round is written to the shared folder, so a lost executor costs one.
    """
    spark = pages.sparkSession
    shared_dir(spark)
    captured = pages.select("url").distinct()
    seeds = seeds.groupBy(F.col("url").alias("seed")).agg(F.max("depth").alias("max_depth"))
    started = seeds.join(captured.withColumnRenamed("url", "seed"), "seed", "left_semi")
    frontier = started.select("seed", F.col("seed").alias("url"), "max_depth")
    deepest = seeds.agg(F.max("max_depth")).first()[0] or 0  # one number
    if deepest <= 1:
        return frontier.select("seed", "url", F.lit(1).alias("depth"))

    edges = host_edges(on_hosts_of(pages, started.withColumnRenamed("seed", "url")))
    edges, size = measured(edges.join(captured.withColumnRenamed("url", "target"), "target", "left_semi").distinct())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # rows come from a grouping as the buckets want them

    few = size <= broadcast_bytes

    def kept(rows: DataFrame) -> DataFrame:
        if few:
            return rows.checkpoint()
        return write_bucketed(rows, scratch_path(spark, "reached"), ["seed", "url"], parts, lasting=False)

    if few:
        frontier, steps = frontier.withColumn("fan", F.lit(1)), F.broadcast(edges)
    else:
        steps, fans = _dealt(edges, hub, parts)
        frontier = frontier.join(fans, "url", "left").withColumn("fan", F.coalesce("fan", F.lit(1)))
    frontier = kept(frontier.groupBy("seed", "url").agg(F.max("max_depth").alias("max_depth"), F.max("fan").alias("fan")))
    rounds = [frontier]
    for depth in range(2, deepest + 1):
        standing = frontier.where(F.col("max_depth") >= depth)
        if few:
            ahead = standing.join(steps, "url").select("seed", F.col("target").alias("url"), "max_depth", "fan")
        else:
            ahead = _stepped(standing, steps, hot)
        ahead = ahead.groupBy("seed", "url").agg(F.max("max_depth").alias("max_depth"), F.max("fan").alias("fan"))
        for earlier in rounds:
            ahead = ahead.join(earlier, ["seed", "url"], "left_anti")
        frontier = kept(ahead)
        if frontier.isEmpty():
            break
        rounds.append(frontier)
    found = [r.select("seed", "url", F.lit(n).alias("depth")) for n, r in enumerate(rounds, 1)]
    return reduce(DataFrame.unionByName, found)


def _dealt(edges: DataFrame, hub: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """The edges ``place, target, fan`` in buckets by place, a part of a page's links, with
    the number of parts of their target; and (url, fan) of the pages in several parts."""
    fans = edges.groupBy("url").agg(F.ceil(F.count("*") / hub).cast("int").alias("fan")).where("fan > 1")
    fans = broadcast_if_small(fans)
    part = F.pmod(F.xxhash64("target"), F.coalesce("fan", F.lit(1)))
    placed = edges.join(fans, "url", "left").select(_place(part), "target")
    ends = fans.select(F.col("url").alias("target"), "fan")
    placed = placed.join(ends, "target", "left").select("place", "target", F.coalesce("fan", F.lit(1)).alias("fan"))
    return write_bucketed(placed, scratch_path(edges.sparkSession, "steps"), "place", parts, lasting=False), fans


def _place(part: Column) -> Column:
    return F.concat_ws(" ", part.cast("string"), F.col("url")).alias("place")


def _stepped(standing: DataFrame, steps: DataFrame, hot: int) -> DataFrame:
    """(seed, url, max_depth, fan) one link further, by the edges in their buckets."""
    at = standing.select("*", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("part"))
    at = at.select("seed", "max_depth", _place(F.col("part")))
    crowded, size = measured(at.groupBy("place").count().where(F.col("count") > hot).select("place"))
    usual, after = at, ["seed", F.col("target").alias("url"), "max_depth", "fan"]
    if size:  # at most one place for each ``hot`` rows of the frontier
        usual = at.join(crowded, "place", "left_anti")
        theirs = broadcast_if_small(steps.join(crowded, "place", "left_semi"))
        return usual.join(steps, "place").select(*after).unionByName(at.join(theirs, "place").select(*after))
    return usual.join(steps, "place").select(*after)


def crawl_frontier(pages: DataFrame, reach: DataFrame) -> DataFrame:
    """``seed, url, target, depth``: same-host links of reached pages to pages not yet
    captured, with the depth at which a fetcher would visit them."""
    captured = pages.select(F.col("url").alias("target")).distinct()
    reached, size = measured(reach.select("url").distinct())
    if size <= BROADCAST_BYTES:  # only the html of reached pages is parsed
        edges = host_edges(pages.join(F.broadcast(reached), "url", "left_semi"))
    else:  # links are narrower to shuffle than html
        edges = host_edges(pages).join(reached, "url", "left_semi")
    missing = edges.distinct().join(captured, "target", "left_anti")
    return reach.join(missing, "url").select(
        "seed", "url", "target", (F.col("depth") + 1).alias("depth")
    )
