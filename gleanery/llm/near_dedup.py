"""Near-duplicates by SetSketch registers.

A document is the set of its distinct word shingles; documents of equal sets form a class,
and everything below works on classes, so that copies cost one row each. A class's sketch
has ``REGISTERS`` registers, each the minimum over the set of an exponential variable, kept
as an exponent of ``B`` truncated to 16 bits. Registers of a union are the maxima of the
registers, and equal ones are the likelier the more two sets overlap: classes that agree
in all ``ROWS`` registers of a band are candidates. The overlap of candidates is estimated
from all their registers together by maximum likelihood given both sizes; pairs whose
estimate is far below the threshold are dropped, the others are confirmed on full sets.

A band's classes are not paired with one another. First each class meets one other only,
the most central one of its bands: that whose own bands hold most classes, as the text does
that a group's others were made from. This connects most of a large group at the cost of a
pair for each class, where two of the others may be too far apart. Then a band offers a few
pivots, central ones again, to its other classes that do not belong to the pivot's component
yet. Bands whose classes are one component are done, so
a group of near copies takes a round or two however large it is. What is open then are
classes that come close to the threshold and mostly do not reach it. Small bands pair those
of different components. Crowded bands that share classes are one crowd: its full sets are
dealt into blocks of bounded size, and a task counts the overlaps of two blocks at once as a
product of matrices, over the shingles that stand in two of their sets at least. It
gives a spanning forest of the links it finds, so no pairs leave it. No link is skipped that
could join two components. The work of a crowd grows with the square of its classes, its
rows with their number times that of its blocks.

A document without words links with nothing, nor does one without an id: its component is
its own id, and it is kept. Rows that share an id are judged one by one by their texts;
identical rows of one id are one document, and stay or go together. Ties cannot arise, as the
smallest id of a component is what stays. A very long text costs work by its length only: its
set is built in one task, its sketch has a fixed size. Without documents nothing is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gleanery.llm.texts import BASE, WordHashes, grams, merge_labels, mix, raw, unused
from gleanery.operators.sizing import broadcast_if_small
from gleanery.session import shared_dir

SHINGLE = 5  # words, unless told otherwise
THRESHOLD = 80  # percent of the union
BANDS, ROWS = 28, 4
REGISTERS = BANDS * ROWS
B, RATE = 1.001, 20.0  # of the registers: step of the exponents, rate of the variables
PIVOTS = 4  # of a band in the second round
CROWD = 64  # classes from which a band's are not paired
BLOCK, ELEMENTS = 8192, 4 << 20  # classes of a crowd, and shingles, that a block holds
EDGES = 100_000  # narrow rows of a task: links, pairs, bands
SKETCHES = 8192  # rows of a task that carry registers
COLUMNS, SLICE, WIDE = 2048, 1024, 4096  # shingles, and classes of both sides, multiplied at once
DOUBT = 20  # percent below the threshold where an estimate is believed: over 5 standard errors

_FACTORS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def shingle_set(text: bytes, hashes: WordHashes, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole text where it has fewer words."""
    words = hashes.of(text.lower().split())
    return np.unique(grams(words, min(shingle, len(words)))) if len(words) else words


def registers(found: np.ndarray) -> np.ndarray:
    least = np.full(REGISTERS, ~np.uint64(0))
    for a in range(0, len(found), 1024):
        least = np.minimum(least, (_FACTORS[:, None] * found[None, a : a + 1024]).min(axis=1))
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(B)), 0, 65535).astype(np.uint16)


def estimate(one: np.ndarray, two: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets of n and m elements (rows of
    registers): the likelihood of how many registers are larger, smaller and equal."""
    above, below = (one > two).sum(axis=1), (one < two).sum(axis=1)
    u, v = n / (n + m), m / (n + m)

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (B - 1) / B) / np.log(B)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return above * np.log(p) + below * np.log(q) + (REGISTERS - above - below) * np.log(np.clip(1 - p - q, 1e-12, 1))

    low, high = np.zeros(len(n)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood is concave
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def _sketcher(shingle: int):
    kind = pa.struct([("n", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary())])

    @F.arrow_udf("struct<n:bigint,digest:binary,registers:binary>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                found = shingle_set(text, hashes, shingle)
                if len(found):
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    rows.append({"n": len(found), "digest": digest, "registers": registers(found).tobytes()})
                else:
                    rows.append({"n": 0, "digest": None, "registers": None})
            yield pa.array(rows, kind)

    return sketch


def _sets(shingle: int):
    @F.arrow_udf("struct<digest:binary,shingles:binary>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for texts in batches:
            found = [shingle_set(t, hashes, shingle).tobytes() for t in texts.to_pylist()]
            digests = [xxhash.xxh3_128_digest(f) for f in found]
            yield pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(found, pa.binary())], ["digest", "shingles"])

    # else a join's filter on the digest makes each set twice, by two Python workers of a task
    return sets.asNondeterministic()


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


@F.arrow_udf(T.DoubleType())
def similarity(one: pa.Array, two: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    return pa.array(estimate(_matrix(one), _matrix(two), n.to_numpy().astype(float), m.to_numpy().astype(float)))


@F.arrow_udf(T.LongType())
def common(one: pa.Array, two: pa.Array) -> pa.Array:
    pairs = zip(one.to_pylist(), two.to_pylist())
    sets = ((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in pairs)
    return pa.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in sets], pa.int64())


def dealt(rows: DataFrame, n: int, each: int = EDGES) -> DataFrame:
    """Some ``n`` rows in as many partitions as that asks for, at most. What is written has a
    file for each partition, and on some stores a process is started for each file."""
    return rows.coalesce(1 + n // each)


def counted(rows: DataFrame, most: int | None = None) -> tuple[DataFrame, int]:
    """The rows, written once, and their number, in as many partitions as that asks for: each
    partition of an exchange's input leaves files of its own, so few rows are not many tasks.
    ``most``: about as many rows as there can be, if that is known before. The rows, which are
    narrow, are exchanged for it: a task that took many partitions of a join would hold the
    hash tables of all of them."""
    rows = (rows if most is None else rows.repartition(1 + most // EDGES)).checkpoint()
    n = rows.count()
    return dealt(rows, n), n


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node of its component.
    ``most``: as many edges as there can be, if that is known before.

    Edges are moved to smaller nodes by turns, first those to larger neighbours, then those
    to smaller ones, until only stars are left."""
    edges, n = counted(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b"), most)
    parts, before = 1 + n // EDGES, None
    while True:
        edges = edges.coalesce(parts)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").coalesce(parts)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        # both edges of a row at once: each use of what stands above makes it anew
        edges = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = edges.where("a > b").coalesce(parts).distinct().coalesce(parts).checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        parts = 1 + now[0] // EDGES
        if now == before:
            edges = edges.coalesce(parts)
            roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
            return counted(dealt(roots.union(edges.select("b", "b").distinct()), now[0]))[0]
        before = now


def _candidates(classes: DataFrame) -> DataFrame:
    """(key, id): the bands that several classes share, with these classes."""
    keys = [F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)]
    bands = classes.select("id", F.explode(F.array(*keys)).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return bands.join(shared, "key", "left_semi")


def _shared(every: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(column, row) of each shingle that two sets hold at least, by column and then by row.
    The columns are numbered in the shingles' order; little is held beside the sets."""
    found = np.concatenate(every)
    found.sort()
    shared = np.unique(found[1:][found[1:] == found[:-1]])
    del found
    if not len(shared):
        return np.empty(0, np.int32), np.empty(0, np.int32)
    columns, counts = [], []
    for one in every:
        at = np.searchsorted(shared, one)
        at = at[shared[np.minimum(at, len(shared) - 1)] == one]
        columns.append(at.astype(np.int32)), counts.append(len(at))
    column = np.concatenate(columns)
    del columns
    order = np.argsort(column, kind="stable")
    row = np.repeat(np.arange(len(every), dtype=np.int32), counts)[order]
    return column[order], row


def overlapping(one: list[np.ndarray], two: list[np.ndarray] | None, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) positions of a spanning forest of the links between two lists of sets,
    or among one. Positions count on from the first list into the second."""
    every = one + (two or [])
    sizes = np.array([len(x) for x in every])
    column, row = _shared(every)
    labels = np.arange(len(every))
    for begin in range(0, len(one), SLICE):
        end = min(begin + SLICE, len(one))
        for low in range(begin if two is None else len(one), len(every), WIDE):
            high = min(low + WIDE, len(every))
            both = np.zeros((end - begin, high - low), np.float32)
            for c in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
                a, b = np.searchsorted(column, [c, c + COLUMNS])
                part, at = row[a:b], column[a:b] - c
                left, right = (part >= begin) & (part < end), (part >= low) & (part < high)
                if not left.any() or not right.any():
                    continue
                x, y = np.zeros((end - begin, COLUMNS), np.float32), np.zeros((high - low, COLUMNS), np.float32)
                x[part[left] - begin, at[left]] = 1
                y[part[right] - low, at[right]] = 1
                both += x @ y.T
            for some in range(0, high - low, SLICE):  # near copies are linked all with all
                total = sizes[begin:end, None] + sizes[None, low + some : min(low + some + SLICE, high)]
                a, b = np.nonzero((100 + threshold) * both[:, some : some + SLICE] >= threshold * total)
                labels = merge_labels(labels, a + begin, b + low + some)
    linked = np.flatnonzero(labels != np.arange(len(every)))
    return linked, labels[linked]


def _forests(threshold: int):
    def forest(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]  # no copies
        block = table["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        split = int((block == block.min()).sum())
        sets, ids = [sets[i] for i in order], ids[order]
        member, root = overlapping(sets[:split], sets[split:] or None, threshold)
        return pa.table({"a": ids[member], "b": ids[root]})

    return forest


def _crowd_links(placed: DataFrame, most: int, narrow: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """(a, b) links that connect the classes of crowded bands ``placed(key, id)``, at most
    ``most`` rows."""
    first = placed.groupBy("key").agg(F.min("id").alias("first"))
    # a class's bands meet in the least of their first classes; classes of the same bands repeat the same edges
    firsts = placed.join(first, "key").groupBy("id").agg(F.collect_set("first").alias("firsts"))
    edges = firsts.select(F.explode(F.concat("firsts", F.array("id"))).alias("a"), F.array_min("firsts").alias("b"))
    crowds = components(edges.where("a != b").distinct(), most)
    members = crowds.join(narrow.select("id", "n"), F.col("node") == F.col("id")).select("id", "n", F.col("root").alias("crowd"))
    members, _ = counted(members, most)
    size = members.groupBy("crowd").agg(F.count("*").alias("m"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("all") / ELEMENTS)).cast("int")
    placed = members.join(size.select("crowd", blocks.alias("blocks")), "crowd")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).join(sets, "id")
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("crowd", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "shingles")
    return met.groupBy("crowd", "x", "y").applyInArrow(_forests(threshold), "a bigint, b bigint")


def links(docs: DataFrame, classes: DataFrame, shingle: int, text: str = "text", threshold: int = THRESHOLD) -> DataFrame | None:
    """(node, root) of the classes that confirmed links join to others."""
    n_classes = classes.count()
    members, n_members = counted(_candidates(classes), BANDS * n_classes)
    wanted = members.select("id").distinct().join(classes, "id").select("id", "digest", F.col("first").alias("_first"))
    wanted, n_wanted = counted(wanted, n_classes)
    firsts = broadcast_if_small(dealt(wanted.select("_first").distinct(), n_wanted))
    few = docs.join(firsts, F.col("doc_id") == F.col("_first"), "left_semi")
    sets = few.select(_sets(shingle)(raw(text)).alias("s")).select("s.digest", "s.shingles").dropDuplicates(["digest"])
    sets = sets.join(wanted, "digest").select("id", "shingles").checkpoint()
    narrow = classes.select("id", "n", "registers")
    tested = roots = None

    def still_open() -> tuple[DataFrame, int]:
        """The bands of several components, with their classes' components and number."""
        if roots is None:
            placed = members.withColumn("root", F.col("id"))
        else:
            placed = members.join(roots, F.col("id") == F.col("node"), "left").select(
                "key", "id", F.coalesce("root", "id").alias("root")
            )
        bands = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"))
        return counted(placed.join(bands.where("x < y").select("key", "n"), "key"), n_members)

    def confirmed(pairs: DataFrame, most: int) -> DataFrame:
        one = narrow.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
        two = narrow.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
        near = pairs.join(one, "a").join(two, "b").where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
        near = near.where(100 * similarity("r_a", "r_b", "n_a", "n_b") >= threshold - DOUBT).select("a", "b", "n_a", "n_b")
        near, n = counted(near, most)
        needed = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        some = sets.join(broadcast_if_small(dealt(needed, 2 * n)), "id", "left_semi")
        near = near.join(some.select(F.col("id").alias("a"), F.col("shingles").alias("s_a")), "a")
        near = near.join(some.select(F.col("id").alias("b"), F.col("shingles").alias("s_b")), "b")
        near = near.withColumn("both", common("s_a", "s_b"))
        return near.where(100 * F.col("both") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")

    def with_links(found: DataFrame, most: int) -> DataFrame | None:
        found, n = counted(found, most)
        if not n:
            return roots
        stars = [] if roots is None else [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
        return components(reduce(DataFrame.union, stars, found))

    for pivots in (0, PIVOTS):  # the first round is the one with a single pair for each class
        placed, n = still_open()
        if not n:
            return roots
        place = F.pmod(F.xxhash64("id", F.lit(pivots)), F.lit(max(pivots, 1)))
        rank = F.struct((-F.sum("n").over(Window.partitionBy("id"))).alias("others"), F.xxhash64("id").alias("h"))
        chosen = placed.withColumn("rank", rank).groupBy("key", place.alias("place")).agg(F.min(F.struct("rank", "id", "root")).alias("p"))
        chosen = chosen.select("key", "p.rank", F.col("p.id").alias("pivot"), F.col("p.root").alias("pivot_root"))
        offered = placed.join(chosen, "key").where("root != pivot_root").select("id", "rank", "pivot")
        if not pivots:
            offered = offered.groupBy("id").agg(F.min(F.struct("rank", "pivot")).alias("p")).select("id", "p.pivot")
        pairs = offered.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs, n_pairs = counted(pairs, n * max(pivots, 1))
        tested = pairs if tested is None else tested.union(pairs)
        roots = with_links(confirmed(pairs, n_pairs), n_pairs)

    placed, n = still_open()
    if not n:
        return roots
    small, crowded = placed.where(F.col("n") <= CROWD), placed.where(F.col("n") > CROWD).select("key", "id")
    other = small.select("key", F.col("id").alias("b"), F.col("root").alias("b_root"))
    pairs = small.join(other, "key").where("id < b and root != b_root").select(F.col("id").alias("a"), "b").distinct()
    most = (small.agg(F.sum("n")).first()[0] or 0) // 2  # a band's number stands beside each of its classes
    pairs, n_pairs = counted(pairs.join(tested, ["a", "b"], "left_anti"), most)
    found = confirmed(pairs, n_pairs)
    found = found if crowded.isEmpty() else found.union(_crowd_links(crowded, n, narrow, sets, threshold))
    return with_links(found, n_pairs + n)


def _key(text: str) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(raw(text))


def _judged(docs: DataFrame, shingle: int, threshold: int, text: str = "text") -> tuple[DataFrame, int]:
    """(doc_id, n_shingles, component_id, kept) of every document, and its text's key; the
    number of documents."""
    shared_dir(docs.sparkSession)
    docs = docs.select("doc_id", text)
    rows = docs.select("doc_id", _key(text).alias("key"), _sketcher(shingle)(raw(text)).alias("s"))
    rows = rows.select("doc_id", "key", "s.*").checkpoint()
    n_rows = rows.count()
    classes = rows.where("doc_id is not null and n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("registers").alias("registers")
    )
    classes = dealt(classes, n_rows, SKETCHES).withColumn("id", F.monotonically_increasing_id()).checkpoint()
    roots = links(docs, classes, shingle, text, threshold)
    of_class = classes.select("digest", "first", "id")
    if roots is None:
        of_class = of_class.select("digest", "first")
    else:
        joined = of_class.join(roots, F.col("id") == F.col("node"))
        least = joined.groupBy("root").agg(F.min("first").alias("least"))
        moved = joined.join(least, "root").select("id", "least")
        moved = broadcast_if_small(moved.repartition(1 + n_rows // EDGES))
        of_class = of_class.join(moved, "id", "left").select("digest", F.coalesce("least", "first").alias("first"))
    found = rows.select("doc_id", "key", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    found = found.join(of_class, "digest", "left")
    component = F.coalesce("first", "doc_id")
    found = found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "key",
    )
    return found, n_rows


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return _judged(docs, shingle, threshold, text)[0].drop("key")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with their own columns, those of the smallest id of each group of
    near-duplicates. A row goes by its id and text, so others that share its id stay."""
    gone, key = unused(docs, "gone"), unused(docs, "key")
    found, n = _judged(docs, shingle, threshold)
    found = found.where("not kept").select(F.col("doc_id").alias(gone), F.col("key").alias(key))
    same = (F.col("doc_id") == F.col(gone)) & (_key("text") == F.col(key))
    return docs.join(broadcast_if_small(dealt(found.distinct(), n)), same, "left_anti")
