"""Keyed tables on plain Parquet, without a lakehouse format.

A batch writes its own ``run=R/batch_id=N`` folders; a job (or streaming checkpoint) owns one
``run`` number, so two jobs never write the same folder. What a batch wrote is seen once it is
published: a record in the manifest, written last, names all its tables, and views read
only what the manifest named when they were asked for. So a reader sees all of a batch or
nothing of it, a failed batch is written again, and a published one is not.

Batches are ordered by when they were first begun, which a small record for each keeps for
replays: a backfill does not outlast the later batches of a running stream. The number is
the time in microseconds, or one more than the greatest published, if clocks differ.

Tables with a key are kept in buckets by its hash, as folders. Views can be asked for one
bucket, which reads that bucket only. ``merge`` rewrites a bucket without what was superseded
and publishes the result in place of what it read; ``expire`` then deletes what nothing refers
to any more. Batches published meanwhile are not touched, and the views do not change.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from gleanery import schemas
from gleanery.functions.vectors import checked_vector
from gleanery.operators.keyed import latest_by, latest_documents
from gleanery.sources.buckets import bucket_count, read_bucketed, write_bucketed

BUCKETS = 8
MERGED = -1  # the run of merged buckets


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, **folders: str):
        """``folders`` renames tables, e.g. ``documents="documents-2"`` after a reindex. The
        number of buckets is for the life of a store."""
        self.spark, self.root, self.buckets, self.folders = spark, root.rstrip("/"), buckets, folders
        self.begun: dict[tuple[int, int], int] = {}

    def folder(self, table: str) -> str:
        return f"{self.root}/{self._name(table)}"

    def _name(self, table: str) -> str:
        return self.folders.get(table, table)

    def renamed(self, **folders: str) -> Store:
        return Store(self.spark, self.root, self.buckets, **{**self.folders, **folders})

    def write(self, table: str, rows: DataFrame, run: int, batch_id: int) -> None:
        schema = schemas.TABLES[table]
        if "commit_id" in schema.names and "commit_id" not in rows.columns:
            rows = rows.withColumn("commit_id", F.lit(self.commit_id(run, batch_id)).cast("bigint"))
        rows, by = rows.select(*schema.names), []
        if table in schemas.KEYS:
            bucket = F.pmod(F.xxhash64(schemas.KEYS[table]), F.lit(self.buckets)).cast("int")
            rows, by = rows.withColumn("bucket", bucket), ["bucket"]
        rows.write.mode("overwrite").partitionBy(*by).parquet(self._place(table, run, batch_id))

    def _place(self, table: str, run: int, batch_id: int) -> str:
        return f"{self.folder(table)}/run={run}/batch_id={batch_id}"

    def commit_id(self, run: int, batch_id: int) -> int:
        """The batch's place in the order of writes, recorded when first asked for."""
        if (run, batch_id) not in self.begun:
            record = f"{self.root}/commits/run={run}/batch_id={batch_id}"
            known = self._load(record, schemas.COMMIT).first()
            number = known[0] if known else self._next()
            if not known:
                self.spark.createDataFrame([(number,)], schemas.COMMIT).coalesce(1).write.mode("overwrite").parquet(record)
            self.begun[run, batch_id] = number
        return self.begun[run, batch_id]

    def _next(self) -> int:
        return max(time.time_ns() // 1000, *self.begun.values(), *(r.commit_id for r in self._manifest()), 0) + 1

    # the manifest

    def publish(self, run: int, batch_id: int, tables: Iterable[str]) -> None:
        """Show what a batch wrote to these tables, all at once."""
        names = sorted(self._name(t) for t in tables)
        commit = self.commit_id(run, batch_id)
        keyed = {self._name(t) for t in schemas.KEYS}
        added = [("add", name, run, batch_id, None, self.buckets if name in keyed else 0, commit) for name in names]
        label = hashlib.md5("/".join(names).encode()).hexdigest()[:8]
        self._record(f"run={run}/batch_id={batch_id}/{label}", added)

    def published(self, table: str, run: int, batch_id: int) -> bool:
        """Whether a batch is there already, so that it must not be written again. Batches of
        a run are numbered upwards; of those expired only the last is remembered."""
        mine = [r for r in self._manifest() if (r.folder, r.run) == (self._name(table), run)]
        return any(batch_id == r.batch_id or r.change == "done" and batch_id < r.batch_id for r in mine)

    def _record(self, name: str, changes: list[tuple]) -> None:
        now = time.time_ns() // 1000
        rows = self.spark.createDataFrame([(*change, now) for change in changes], schemas.MANIFEST)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest/{name}")

    def _manifest(self) -> list[Row]:
        """Every change that was published: a few rows for each batch and bucket."""
        try:
            files = self.spark.read.schema(schemas.MANIFEST).option("recursiveFileLookup", True)
            rows = files.json(f"{self.root}/manifest").select("*", F.col("_metadata.file_path").alias("file")).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if wrong := {r.buckets for r in rows} - {0, self.buckets}:
            raise ValueError(f"{self.root} has {wrong.pop()} buckets, not {self.buckets}")
        return rows

    def live(self) -> set[tuple]:
        """(folder, run, batch_id, bucket) of what readers see now; bucket None without one."""
        return self._live(self._manifest())

    @staticmethod
    def _live(rows: list[Row]) -> set[tuple]:
        added, dropped = set(), set()
        for r in rows:
            if r.change != "done":
                every = range(r.buckets) if r.bucket is None and r.buckets else [r.bucket]
                (added if r.change == "add" else dropped).update((r.folder, r.run, r.batch_id, b) for b in every)
        return added - dropped

    # reading

    def read(self, table: str, bucket: int | None = None, live: set[tuple] | None = None) -> DataFrame:
        """Every published row, of one bucket if it is given. ``live`` pins what is seen."""
        live = self.live() if live is None else live
        mine = [x for x in live if x[0] == self._name(table) and bucket in (None, x[3])]
        schema = schemas.TABLES[table]
        if not mine:
            return self.spark.createDataFrame([], schema)
        parts = ["run", "batch_id"] + (["bucket"] if table in schemas.KEYS else [])
        seen = F.concat_ws("/", *parts).isin(["/".join(map(str, x[1 : 1 + len(parts)])) for x in sorted(mine)])
        return self._load(self.folder(table), schema, seen)

    def read_batch(self, table: str, run: int, batch_id: int) -> DataFrame:
        """What a batch wrote, published or not."""
        return self._load(self._place(table, run, batch_id), schemas.TABLES[table])

    def _load(self, folder: str, schema, seen=None) -> DataFrame:
        try:
            rows = self.spark.read.schema(schema).parquet(folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return (rows if seen is None else rows.where(seen)).select(*schema.names)

    # writers

    def upsert_documents(self, rows: DataFrame, dim: int, run: int, batch_id: int) -> None:
        checked = rows.withColumn("embed", checked_vector(F.col("embed"), dim))
        self.write("documents", checked, run, batch_id)

    def append_ownership(self, edges: DataFrame, run: int, batch_id: int) -> None:
        """Clustered by user, so a scan for some users skips row groups. The range
        includes the document, so one user with most edges is still many files."""
        clustered = edges.repartitionByRange("user_id", "document_id").sortWithinPartitions("user_id")
        self.write("ownership", clustered, run, batch_id)

    # last-write-wins views, of everything or of one bucket

    def snapshots(self, bucket: int | None = None) -> DataFrame:
        return latest_by(self.read("page_snapshots", bucket), ["url_key"], "commit_id")

    def crawl_log(self, bucket: int | None = None) -> DataFrame:
        return latest_by(self.read("crawl_log", bucket), ["url_key", "url"], "commit_id").drop("commit_id")

    def documents(self, bucket: int | None = None) -> DataFrame:
        """Documents of each page's latest snapshot. A page that shrank, even to no
        words at all, loses its old chunks."""
        live = self.live()
        rows, versions = self.read("documents", bucket, live), self.read("page_snapshots", bucket, live)
        return latest_by(rows, ["url_key"], "commit_id", versions=versions)

    def documents_by_id(self, bucket: int | None = None) -> DataFrame:
        """Last write per id alone, stale trailing chunks included."""
        return latest_documents(self.read("documents", bucket))

    def ownership(self) -> DataFrame:
        return self.read("ownership").distinct()

    def conversations(self, bucket: int | None = None) -> DataFrame:
        """Last batch per event id; within a batch ids are already distinct."""
        return latest_by(self.read("conversations", bucket), ["id"], "commit_id").drop("commit_id", "seq")

    # upkeep

    def compact(self, table: str, folder: str) -> None:
        """Rewrite a view as one batch of a new folder; point a new Store at it."""
        views = {
            "page_snapshots": self.snapshots,
            "documents": self.documents,
            "ownership": self.ownership,
            "crawl_log": lambda: latest_by(self.read("crawl_log"), ["url_key", "url"], "commit_id"),
            "conversations": lambda: latest_by(self.read("conversations"), ["id"], "commit_id"),
        }
        compacted = Store(self.spark, self.root, self.buckets, **{table: folder})
        compacted.write(table, views[table](), run=0, batch_id=0)
        compacted.publish(0, 0, [table])

    def merge(self, bucket: int, tables: Iterable[str] = tuple(schemas.KEYS)) -> None:
        """Rewrite one bucket of the keyed tables as the last write of every key, with its
        commit number, in place of what is published of it now. Ownership is a set, of which
        each edge stays once. No other bucket is read."""
        keys = {"page_snapshots": ["url_key"], "documents": ["id"], "crawl_log": ["url_key", "url"], "conversations": ["id"]}
        live, number = self.live(), self._next()
        changes = []
        for table in tables:
            name = self._name(table)
            old = [x for x in live if x[0] == name and x[3] == bucket]
            if not old or {x[1] for x in old} == {MERGED}:
                continue  # nothing was written since the last time
            rows = self.read(table, bucket, live)
            rows = latest_by(rows, keys[table], "commit_id") if table in keys else rows.distinct()
            self.write(table, rows, MERGED, number)
            changes.append(("add", name, MERGED, number, bucket, self.buckets, number))
            changes += [("drop", *x, self.buckets, number) for x in sorted(old)]
        if changes:
            self._record(f"merged/{uuid.uuid4().hex}", changes)

    def expire(self, keep_events: int = 1, grace_seconds: float = 3600) -> None:
        """Drop the captured events, html and all, of all but the newest ``keep_events`` batches;
        delete what was merged away or dropped over ``grace_seconds`` ago, as readers that began
        before may still be at it; and let one record stand for those that are as old."""
        rows = self._manifest()
        events = self._name("page_events")
        batches = sorted({(r.commit_id, r.run, r.batch_id) for r in rows if (r.folder, r.change) == (events, "add")})
        still = self._live(rows)
        past = [x for x in batches[: max(len(batches) - keep_events, 0)] if (events, *x[1:], None) in still]
        if past:
            self._record(f"expired/{uuid.uuid4().hex}", [("drop", events, run, batch, None, 0, commit) for commit, run, batch in past])
            rows = self._manifest()
        before = time.time_ns() // 1000 - int(grace_seconds * 1e6)
        settled = [r for r in rows if r.at <= before]
        self._delete_dropped(settled, self._live(rows))
        if len(files := {r.file for r in settled}) > 1:
            self._record(f"settled/{uuid.uuid4().hex}", self._standing(settled))
            # what was added goes before what dropped it, so nothing comes back in between
            dropping = {r.file for r in settled if r.change == "drop"}
            for file in sorted(files, key=lambda f: f in dropping):
                self._delete(file)

    def _delete_dropped(self, settled: list[Row], live: set[tuple]) -> None:
        used = {x[:3] for x in live}
        busy = {x[1:3] for x in live}
        for folder, run, batch, bucket in {(r.folder, r.run, r.batch_id, r.bucket) for r in settled if r.change == "drop"}:
            place = f"{self.root}/{folder}/run={run}/batch_id={batch}"
            self._delete(place if bucket is None or (folder, run, batch) not in used else f"{place}/bucket={bucket}")
            if (run, batch) not in busy:
                self._delete(f"{self.root}/commits/run={run}/batch_id={batch}")

    def _standing(self, settled: list[Row]) -> list[tuple]:
        """What is left of settled changes. Nothing that is not settled is dropped by them."""
        live, kept, last = self._live(settled), [], {}
        for r in settled:
            if r.change == "add":
                every = range(r.buckets) if r.bucket is None and r.buckets else [r.bucket]
                left = [b for b in every if (r.folder, r.run, r.batch_id, b) in live]
                whole = len(left) == len(every)
                kept += [("add", r.folder, r.run, r.batch_id, b, r.buckets, r.commit_id) for b in ([r.bucket] if whole else left)]
            if r.change != "drop" and r.run != MERGED:
                last[r.folder, r.run] = max(last.get((r.folder, r.run), (r.batch_id, r.commit_id)), (r.batch_id, r.commit_id))
        return kept + [("done", folder, run, batch, None, 0, commit) for (folder, run), (batch, commit) in last.items()]

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    # copies that answer questions

    def serve_documents(self, folder: str, buckets: int | None = None) -> DataFrame:
        """Copy the view of the documents into a new folder, in buckets by id, and read it
        from there: owners and hits find their documents without an exchange of vectors or
        chunks. Without a number of buckets, the view is measured first."""
        view = self.documents().select("id", "url_key", "chunk", "embed", "offset")
        return write_bucketed(view, f"{self.root}/{folder}", "id", buckets or bucket_count(view))

    def served_documents(self, folder: str) -> DataFrame:
        return read_bucketed(self.spark, f"{self.root}/{folder}")
