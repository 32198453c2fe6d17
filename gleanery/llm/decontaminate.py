"""Benchmark decontamination by winnowing.

Of every ``TOGETHER`` consecutive k-gram hashes the smallest is a fingerprint, so a
document and a benchmark item that share a span of ``WINDOW`` words share a fingerprint.
The fingerprints of the benchmark meet those of the documents, and around each hit the
windows holding it are compared with the item's. Items shorter than a window are looked
up whole, by their own length.

The benchmark's index is broadcast only while the benchmark was measured to be small. A
larger benchmark is searched in blocks of bounded size, each past all documents.

Null or wordless texts have no words. Items without an id or words are no items; repeated
items with one id are one item, with the windows of each. Rows of documents are judged one
by one, repeated or not. An empty benchmark hits nothing, and without documents nothing is
returned. A very long text is searched whole, in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gleanery.llm.texts import WordHashes, chunks, grams, raw, unused
from gleanery.session import scratch_path

WINDOW = 10  # words that count as a passage of an item
GRAM = 5
TOGETHER = WINDOW - GRAM + 1
BLOCK_BYTES = 16 << 20  # of benchmark text in one index

# Letters become lower case; what is no letter, digit or part of a longer character is a gap.
_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_GAP = np.full(WINDOW, 1, np.uint64)  # stands between documents; no window holds it

RESULT = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest k-gram hash at each position's run of ``TOGETHER``, and the k-grams."""
    every = grams(hashes, GRAM)
    n = len(every) - TOGETHER + 1
    if n <= 0:
        return np.empty(0, np.uint64), every
    least = every[:n].copy()
    for i in range(1, TOGETHER):
        np.minimum(least, every[i : i + n], out=least)
    return least, every


class Index:
    """Fingerprints and windows of a block of items, as sorted arrays."""

    def __init__(self, items: list[tuple[str, bytes]]):
        hashes = WordHashes()
        self.items = [i for i, _ in items]
        each = [hashes.of(words(text)) for _, text in items]
        self.words = np.concatenate(each) if each else np.empty(0, np.uint64)
        starts = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
        found, by_length = [], {}
        for n, e in enumerate(each):
            if not len(e):
                continue
            length = min(len(e), WINDOW)
            if length == WINDOW:
                found.append(fingerprints(e)[0])
            gram = grams(e, length)
            at = starts[n] + np.arange(len(gram))
            by_length.setdefault(length, []).append((gram, at, np.full(len(gram), n)))
        self.prints = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
        self.windows = {}
        for length, parts in by_length.items():
            gram, at, item = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((item, gram))
            gram, at, item = gram[order], at[order], item[order]
            values, first, count = np.unique(gram, return_index=True, return_counts=True)
            self.windows[length] = (values, at[first], first, count, item)

    def matches(self, hashes: np.ndarray):
        """(start, length, items) arrays of every window occurring among the words."""
        for length, (values, at, first, count, item) in self.windows.items():
            if length == WINDOW:
                least, _ = fingerprints(hashes)
                starts = np.flatnonzero(among(least, self.prints))
            else:
                starts = np.arange(len(hashes) - length + 1)
            if not len(starts):
                continue
            gram = grams(hashes, length)[starts]
            place = np.minimum(np.searchsorted(values, gram), len(values) - 1)
            hit = values[place] == gram
            starts, place = starts[hit], place[hit]
            if len(starts):
                reach = np.arange(length)
                same = (hashes[starts[:, None] + reach] == self.words[at[place][:, None] + reach]).all(axis=1)
                starts, place = starts[same], place[same]
            yield starts, length, place, (first, count, item)

    def search(self, texts: list[bytes], hashes: WordHashes):
        for a, b in chunks(texts):
            each = [words(t) for t in texts[a:b]]
            parts, begins, at = [], [], 0
            for w in each:
                begins.append(at)
                parts += [hashes.of(w), _GAP]
                at += len(w) + WINDOW
            begins = np.array(begins)
            flat = np.concatenate(parts)
            rows = {}
            for starts, length, place, (first, count, item) in self.matches(flat):
                owner = np.searchsorted(begins, starts, side="right") - 1
                for n in np.unique(owner):
                    mine = owner == n
                    spans, items = rows.setdefault(int(n), ([], set()))
                    spans += [(int(s), int(s) + length) for s in starts[mine] - begins[n]]
                    for p in np.unique(place[mine]):
                        items.update(self.items[i] for i in item[first[p] : first[p] + count[p]])
            for n, w in enumerate(each):
                spans, items = rows.get(n, ((), ()))
                yield len(w), merged(spans), sorted(items)


def among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def merged(spans) -> list[dict]:
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _searcher(shared):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(RESULT)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for texts in batches:
            rows = shared.value.search(texts.to_pylist(), hashes)
            yield pa.array([{"n_words": n, "spans": s, "items": i} for n, s, i in rows], kind)

    return search


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, into: str = "hits"
) -> DataFrame:
    """The documents' columns and a struct ``into`` (in place of such a column): n_words, the word spans that occur in
    the benchmark (ends exclusive, merged), and the ids, as strings, of the items hit."""
    spark = docs.sparkSession
    known = benchmark.select(F.col("item_id").cast("string").alias("item"), raw().alias("body")).where("item is not null")
    size = known.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    if size <= block_bytes:
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in known.collect()]))
        return docs.withColumn(into, _searcher(index)(raw(text)))
    docs = docs.drop(into)
    table, blocks = scratch_path(spark, "documents"), -(-size // block_bytes)
    number = unused(docs, "row")
    docs.withColumn(number, F.monotonically_increasing_id()).write.parquet(table)
    docs, found = spark.read.parquet(table), scratch_path(spark, "hits")
    for b in range(blocks):
        items = known.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b).collect()
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in items]))
        hits = docs.select(F.col(number).alias("row"), _searcher(index)(raw(text)).alias("h"))
        hits.where("size(h.items) > 0 or %d = 0" % b).write.mode("append").parquet(found)
        index.destroy()
    all_spans = F.flatten(F.collect_list("h.spans"))
    one = spark.read.parquet(found).groupBy(F.col("row").alias(number)).agg(
        F.struct(
            F.max("h.n_words").alias("n_words"),
            union_of(all_spans).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("h.items")))).alias("items"),
        ).alias(into)
    )
    return docs.join(one, number).drop(number)


def union_of(spans: Column) -> Column:
    """Spans of several blocks as disjoint ones: the part of each beyond all earlier ends."""
    def step(acc, s):
        start = F.greatest(acc["end"], s["start"])
        fresh = F.filter(F.array(F.struct(start.alias("start"), s["end"].alias("end"))), lambda x: x["start"] < x["end"])
        return F.struct(F.concat(acc["spans"], fresh).alias("spans"), F.greatest(acc["end"], s["end"]).alias("end"))

    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return F.aggregate(F.array_sort(spans), F.struct(none.alias("spans"), F.lit(0).alias("end")), step)["spans"]


def n_hit(hits: str = "hits") -> Column:
    """Number of words inside the spans."""
    add = lambda acc, s: acc + (s["end"] - s["start"])
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("bigint"), add)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of an item occurs, with their own columns."""
    hits = unused(docs, "hits")
    return benchmark_hits(docs, benchmark, into=hits).where(F.size(f"{hits}.items") == 0).drop(hits)
