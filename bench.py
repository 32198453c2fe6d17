"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from gleanery.catalog.queries import QUERIES
from gleanery.session import build_session

HEADLINE = [
    "extract_page_text",
    "clean_document_text",
    "chunk_documents",
    "embed_document_chunks",
    "page_links",
    "resolved_page_links",
    "latest_page_snapshots",
    "page_crawl_log",
    "ownership_of_pages",
    "nearest_vectors",
    "nearest_owned_vectors",
    "paired_turns",
    "turns_to_last_user",
    "crawl_frontier_depth_1",
    "crawl_reach_depth_4",
    "indexed_documents",
    "streamed_documents",
    "streamed_conversations",
    "retrieved_hits",
    "retrieval_prompts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "gleanery-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the Python workers and the JIT on the smallest query, untimed
    QUERIES["extract_page_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
