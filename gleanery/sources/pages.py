"""Folders of stored pages: ``<key>.html`` files and their ``<key>.log`` crawl logs.

Executors write the files straight to the folder, which is a path or URI that all of them
reach. A file gets its name once it is whole, so a task that is lost or run twice leaves no
part of one; pages written again replace theirs.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NAME_BYTES = 255  # of a file name, in the common file systems
READS = 64  # partitions that Spark makes of small files, a few files each, that one task reads
_HEADER = ["url", "timestamp"]


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """``url_key, html`` of every ``*.html`` file, read whole as UTF-8."""
    files = spark.read.option("pathGlobFilter", "*.html").text(folder, wholetext=True)
    key = F.regexp_replace("_metadata.file_name", r"\.html$", "")
    return _in_few_tasks(files.select(_decoded(key).alias("url_key"), F.col("value").alias("html")))


def read_crawl_logs(spark: SparkSession, folder: str) -> DataFrame:
    """``url_key, url, ts`` of every ``*.log`` file (CSV with a header)."""
    files = (
        spark.read.option("pathGlobFilter", "*.log")
        .option("header", True)
        .option("escape", '"')
        .schema("url STRING, timestamp BIGINT")
        .csv(folder)
    )
    key = F.regexp_replace("_metadata.file_name", r"\.log$", "")
    return _in_few_tasks(files.select(_decoded(key).alias("url_key"), "url", F.col("timestamp").alias("ts")))


def _in_few_tasks(files: DataFrame) -> DataFrame:
    """The rows of small files, many files to a task, without an exchange: a task that has a few
    only writes as many files as one that has thousands. No fewer tasks than run at once."""
    parts = files.rdd.getNumPartitions()
    return files.coalesce(max(files.sparkSession.sparkContext.defaultParallelism, -(-parts // READS)))


def nameable(key: Column) -> Column:
    """Whether a key can name a file that is found again: readers pass over names that
    begin with "_" or ".", and file systems refuse long ones."""
    fits = F.octet_length(key).between(1, NAME_BYTES - len(".html")) & ~key.contains("/")
    return F.coalesce(fits & ~key.startswith("_") & ~key.startswith("."), F.lit(False))


def write_page_folder(snapshots: DataFrame, log: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """One ``<key>.html`` for each row of ``snapshots(url_key, html)``, whose keys are unique,
    and one ``<key>.log`` for each key of ``log(url_key, url, ts)``. Gives back the rows of
    both whose keys cannot name a file (``nameable``), which are not written.

    Pages are written where they lie, without a shuffle. The lines of a log are brought
    together and written as they come, so a much-captured key takes no memory. A page
    without text is an empty file, which ``read_snapshots`` does not list.
    """
    named = nameable(F.col("url_key"))
    pages = snapshots.where(named).select("url_key", F.coalesce("html", F.lit("")).alias("html"))
    _written(pages, _pages(folder))
    lines = log.where(named).select("url_key", "url", "ts").repartition("url_key").sortWithinPartitions("url_key", "ts", "url")
    _written(lines, _logs(folder))
    return snapshots.where(~named), log.where(~named)


def _written(rows: DataFrame, write) -> None:
    rows.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()  # one number


def _put(place: fs.FileSystem, root: str, name: str, parts: Iterable[str]) -> None:
    """Write a file under a name that no reader lists, then give it its own."""
    draft = f"{root}/.{uuid.uuid4().hex}"
    with place.open_output_stream(draft) as out:
        for part in parts:
            out.write(part.encode())
    place.move(draft, f"{root}/{name}")


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    place, root = fs.FileSystem.from_uri(folder)
    place.create_dir(root, recursive=True)
    return place, root.rstrip("/")


def _count(files: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])


def _pages(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = _open(folder)
        for batch in batches:
            for key, html in zip(batch.column(0), batch.column(1)):
                _put(place, root, f"{key.as_py()}.html", [html.as_py()])
            yield _count(batch.num_rows)

    return write


def _line(row) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(row)
    return out.getvalue()


def _logs(folder: str):
    def text(rows) -> Iterator[str]:
        yield _line(_HEADER)
        for _, url, ts in rows:
            yield _line((url, ts))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = _open(folder)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        files = 0
        for key, lines in groupby(rows, key=lambda row: row[0]):
            _put(place, root, f"{key}.log", text(lines))
            files += 1
        yield _count(files)

    return write


def export_crawl_log(log: DataFrame, folder: str) -> None:
    """The crawl log as CSV with a header."""
    log.select("url_key", "url", F.col("ts").alias("timestamp")).write.option("header", True).csv(folder)


def _decoded(file_name):
    """File names are reported URL-encoded; "+" stands for itself there."""
    return F.try_url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))
