"""From user text to a crawl plan over captured pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from gleanery.operators.links import crawl_frontier, crawl_reach, extract_urls, valid_depth


class CrawlPlan(NamedTuple):
    seeds: DataFrame
    reach: DataFrame
    frontier: DataFrame
    fetches: DataFrame
    dead_letter: DataFrame


def crawl_plan(requests: DataFrame, pages: DataFrame) -> CrawlPlan:
    """Plan the crawl of ``requests(text, depth)`` over captured ``pages(url, html)``:
    valid seeds, the captured pages within depth, the links one step beyond them, and what
    a fetcher is to fetch: seeds not captured yet, and links beyond captured pages, as far
    as the seed's depth reaches."""
    seeds, rejected = valid_depth(extract_urls(requests.select("text", "depth"), "text"))
    seeds = seeds.groupBy("url").agg(F.max("depth").alias("depth"))
    reach = crawl_reach(pages, seeds)
    frontier = crawl_frontier(pages, reach)
    captured = pages.select("url").distinct()
    fresh = seeds.join(captured, "url", "left_anti").select(
        F.col("url").alias("seed"), F.lit(None).cast("string").alias("url"), F.col("url").alias("target"), F.lit(1).alias("depth")
    )
    limits = seeds.select(F.col("url").alias("seed"), F.col("depth").alias("limit"))
    within = frontier.join(limits, "seed").where("depth <= limit").drop("limit")
    return CrawlPlan(seeds, reach, frontier, fresh.unionByName(within), rejected)
