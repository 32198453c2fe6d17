"""Exact nearest neighbours of many questions in one job over the vectors.

No question x document pair is ever a row. The questions are broadcast as matrices; every
task streams its Arrow batches of vectors past them and keeps k candidates per question, so
what leaves a task is at most k rows per question. These are merged in two stages, first
those of ``FAN_IN`` tasks each, then what is left of a question, so that no group holds the
rows of all tasks.

Open and scoped questions pass the same scan: a document comes with the list of the scopes
that own it, from a join on its id. The lists are broadcast where they were measured to be
small. Otherwise both sides meet by the hash of the id, and vectors that are kept in buckets
by id (``gleanery.sources.buckets``) are not exchanged for it; nor are they ever for open
questions. Where no question is open, unowned documents do not leave the join.

Questions beyond what a task may hold never pass the driver. They are dealt, by scope, into
partitions as large as a task may hold, and every partition of the vectors meets every one of
them: both sides are packed into blocks, a row for each partition of the questions and each
Arrow batch of the vectors, and written once, so what is paired are blocks in one job, and no
vector is exchanged for it. A partition's vectors are put in the order of their owners first,
so that most blocks are of few scopes; blocks without a scope in common are not paired. The
questions go to a task with the first pair only. Vectors are array<float> or array<double>,
and are compared as what they are; other arrays are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from gleanery.operators import sizing

K = 7  # fixed value: documents found per question
QUESTION_BYTES = 256 << 20  # of the questions and their candidates that one task holds
OWNER_BYTES = sizing.BROADCAST_BYTES  # of the lists of owners, or the ids that were hit, that are broadcast
PAIR_BLOCK = 4 << 20  # distances held at once by one task
MOST_DEALT = 64 << 20  # of questions in a partition; more of them save no more reading of the vectors
FAN_IN = 256  # tasks whose rows of a question are merged first
FEW_HITS = 250_000  # rows of a question id, a document id and two numbers
CANDIDATE_BYTES = 128  # of a task for each of the k candidates of a question
SMALL_SCOPE = 1 << 14  # pairs of a scope in a batch below which all are compared

FEW_USERS = 256  # that are listed in a filter

_PARTIAL = "qid string, part int, document_id string, dist double"
_QUESTIONS = "qids array<string>, questions binary, places binary, asking array<bigint>"
_DOCUMENTS = (
    "source int, number int, ids array<string>, width int, vectors binary, filled binary, firsts binary, owned binary, owners binary,"
    " owning array<bigint>"
)
_PAIRED = ["ids", "width", "vectors", "filled", "firsts", "owned", "owners"]
_ENTRIES = {T.FloatType: "float32", T.DoubleType: "float64"}
_OPEN = -1  # the place of questions about everything, before those of users


def _asked(table: pa.Table) -> dict:
    """The broadcast side: vectors ordered by scope, and where each scope lies. The open
    scope is named "", and so the first, if there is one.

    Plain values only: a broadcast is pickled by reference, and executors need not have
    this package installed."""
    table = table.sort_by("scope").combine_chunks()
    scopes = np.array(table["scope"].to_pylist(), dtype=object)
    names, starts, counts = np.unique(scopes, return_index=True, return_counts=True)
    return {
        "qids": np.array(table["qid"].to_pylist(), dtype=object),
        "vectors": _matrix(table["embed"].combine_chunks()),
        "scopes": names.tolist(),
        "starts": starts,
        "counts": counts,
    }


class _Best:
    """The k nearest documents one task has seen so far, for every question."""

    def __init__(self, asked: dict, k: int):
        self.qids, self.k = asked["qids"], k
        self.starts, self.counts, self.open = asked["starts"], asked["counts"], asked["scopes"][0] == ""
        self.q = asked["vectors"]
        self.rough = _single(self.q, np.ones(len(self.q)))
        if self.q.dtype == np.float32:  # held once
            self.q = self.rough[:, :-1]
        self.norms = np.einsum("ij,ij->i", self.q, self.q, dtype=np.float64)
        self.bound = np.full(len(self.q), np.inf)
        self.held = np.zeros(len(self.q), np.int64)
        self.dist = np.empty((len(self.q), k))
        self.ids = np.empty((len(self.q), k), object)

    def offer(self, ids: np.ndarray, vectors: np.ndarray, owners: pa.ListArray | None, firsts: np.ndarray | None = None) -> None:
        """One batch of documents, each with the places of the scopes that own it. ``firsts``
        are the rows that ``distinct`` gives, where they are known."""
        if vectors.shape[1] != self.q.shape[1]:
            raise ValueError(f"document vectors have {vectors.shape[1]} dimensions, questions {self.q.shape[1]}")
        places = rows = np.empty(0, np.int64)
        if owners is not None:
            places = owners.flatten().to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(len(ids)), np.diff(owners.offsets.to_numpy()))
            each = np.bincount(places, minlength=len(self.counts)) * self.counts
            if len(ids) > 1 and each[each <= SMALL_SCOPE].sum() > PAIR_BLOCK:
                half = len(ids) // 2
                self.offer(ids[:half], vectors[:half], owners[:half])
                self.offer(ids[half:], vectors[half:], owners[half:])
                return
        if self.open:
            places = np.concatenate([np.zeros(len(ids), np.int64), places])
            rows = np.concatenate([np.arange(len(ids)), rows])
        if not len(rows):
            return
        firsts = self.distinct(vectors) if firsts is None else firsts
        copies, first = self._copies(places, rows, firsts, ids)
        q_at, at = self._candidates(copies["place"][first], copies["vector"][first], vectors)
        dist = self._exact(vectors, q_at, copies["vector"][first[at]])
        near = dist <= self.bound[q_at]
        q_at, at, dist = q_at[near], at[near], dist[near]
        each = np.diff(np.append(first, len(copies["row"])))[at]
        rows = copies["row"][np.repeat(first[at], each) + _within(each)]
        self._keep(np.repeat(q_at, each), np.repeat(dist, each), ids[rows])

    @staticmethod
    def distinct(vectors: np.ndarray) -> np.ndarray:
        """For each row the first row holding the same vector."""
        as_bytes = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel()
        _, first, copy_of = np.unique(as_bytes, return_index=True, return_inverse=True)
        return first[copy_of]

    def _copies(self, places, rows, firsts, ids) -> tuple[dict, np.ndarray]:
        """(place, vector, row) of the documents in each scope, those of one vector in a run,
        and where the runs begin. Copies of one vector rank by id: k of them are enough,
        compared once."""
        vector = firsts[rows]
        order = np.lexsort((vector, places))
        found = {"place": places[order], "vector": vector[order], "row": rows[order]}
        new = (np.diff(found["place"], prepend=-1) != 0) | (np.diff(found["vector"], prepend=-1) != 0)
        first = np.flatnonzero(new)
        each = np.diff(np.append(first, len(order)))
        if (each > self.k).any():
            kept = np.ones(len(order), bool)
            for at, n in zip(first[each > self.k], each[each > self.k], strict=True):
                ranks = _id_ranks(ids[found["row"][at : at + n]])
                kept[at : at + n] = np.argsort(np.argsort(ranks, kind="stable")) < self.k
                new[at] = False
                new[at + int(np.argmax(kept[at : at + n]))] = True
            found, first = {name: values[kept] for name, values in found.items()}, np.flatnonzero(new[kept])
        return found, first

    def _candidates(self, places: np.ndarray, at: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(question, position in ``at``) of what may rank, of the vectors ``at`` in scopes in
        order. Large scopes are narrowed down by matrix products; of small ones every pair is
        taken."""
        sizes = np.bincount(places, minlength=len(self.counts))
        large = sizes * self.counts > SMALL_SCOPE
        few = np.flatnonzero(~large[places])
        each = self.counts[places[few]]
        pairs = [(np.repeat(self.starts[places[few]], each) + _within(each), np.repeat(few, each))]
        begins = np.cumsum(sizes) - sizes
        for place in np.flatnonzero(large):
            part = slice(begins[place], begins[place] + sizes[place])
            for q_at, d_at in self._narrowed(self.starts[place], self.counts[place], vectors[at[part]]):
                pairs.append((q_at, d_at + part.start))
        return np.concatenate([q for q, _ in pairs]), np.concatenate([d for _, d in pairs])

    def _narrowed(self, start: int, n: int, vectors: np.ndarray) -> Iterator[tuple]:
        """Candidates of questions start..start+n among the vectors, by distances in single
        precision: half of |q|^2 less the distance is q.v - |v|^2 / 2, one matrix product. The
        error of the distance is below a third of ``slack`` (the worst case of a dot product
        of this length, rounding of the entries included), so the exact pass misses no
        neighbour."""
        norms = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
        rough, most = _single(vectors, norms / -2).T, norms.max()
        step = max(1, PAIR_BLOCK // len(vectors))
        for begin in range(start, start + n, step):
            part = slice(begin, min(begin + step, start + n))
            scale = self.norms[part] + most
            if not scale.max() < 1e30:  # beyond single precision
                near = np.ones((len(scale), len(vectors)), bool)
            else:
                slack = 4 * (vectors.shape[1] + 8) * float(np.finfo(np.float32).eps) * scale
                score = self.rough[part] @ rough
                least = (self.norms[part] - self.bound[part] - slack) / 2
                near = score >= least.astype(np.float32)[:, None]
                loose = np.flatnonzero(np.count_nonzero(near, axis=1) > 2 * self.k)
                if len(loose):  # what was seen before lies further off than k of these
                    every = score if len(loose) == len(score) else score[loose]
                    least = np.partition(every, len(vectors) - self.k, axis=1)[:, -self.k] - slack[loose]
                    near[loose] &= every >= least.astype(np.float32)[:, None]
            q_at, d_at = np.divmod(np.flatnonzero(near), len(vectors))
            yield q_at + begin, d_at

    def _exact(self, vectors, q_at, d_at) -> np.ndarray:
        """Squared distances in double, summed in dimension order like a sequential fold."""
        dist = np.empty(len(q_at))
        for at in range(0, len(q_at), 256):  # that stay in a core's cache
            part = slice(at, at + 256)
            gaps = self.q[q_at[part]].astype(np.float64) - vectors[d_at[part]]
            dist[part] = np.cumsum(gaps * gaps, axis=1)[:, -1]
        return dist

    def _keep(self, q: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(q)
        old = touched.repeat(self.held[touched]), _within(self.held[touched])
        q, dist = np.concatenate([old[0], q]), np.concatenate([self.dist[old], dist])
        ids = np.concatenate([self.ids[old], ids])
        order = np.lexsort((dist, q))
        same = (np.diff(q[order]) == 0) & (np.diff(dist[order]) == 0)
        if same.any():  # ties by id
            tied = order[np.append(same, False) | np.append(False, same)]
            ranks = np.zeros(len(q), np.int64)
            ranks[tied] = _id_ranks(ids[tied])
            order = np.lexsort((ranks, dist, q))
        q, dist, ids = q[order], dist[order], ids[order]
        each = np.bincount(np.searchsorted(touched, q), minlength=len(touched))
        rank = _within(each)
        best = rank < self.k
        self.dist[q[best], rank[best]], self.ids[q[best], rank[best]] = dist[best], ids[best]
        self.held[touched] = np.minimum(each, self.k)
        full = touched[each >= self.k]
        self.bound[full] = self.dist[full, self.k - 1]

    @property
    def rows(self) -> pd.DataFrame:
        at = np.arange(len(self.held)).repeat(self.held), _within(self.held)
        return pd.DataFrame({"q": at[0], "dist": self.dist[at], "id": self.ids[at]})

    def emit(self, part: int) -> pa.RecordBatch:
        rows = self.rows
        qids = self.qids[rows["q"].to_numpy(np.int64)]
        parts = pa.array(np.full(len(qids), part, np.int32))
        columns = [pa.array(qids, pa.string()), parts, pa.array(rows["id"], pa.string()), pa.array(rows["dist"])]
        return pa.RecordBatch.from_arrays(columns, names=["qid", "part", "document_id", "dist"])


def _within(each: np.ndarray) -> np.ndarray:
    """0, 1, ... within runs of these lengths."""
    return np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)


def _id_ranks(ids: np.ndarray) -> np.ndarray:
    """Places of the ids in their order, nulls last."""
    ranks = np.empty(len(ids), np.int64)
    ranks[sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] or ""))] = np.arange(len(ids))
    return ranks


def _single(vectors: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The vectors in single precision with one more entry each."""
    rows = np.empty((len(vectors), vectors.shape[1] + 1), np.float32)
    with np.errstate(over="ignore"):  # what is beyond single precision is not narrowed by it
        rows[:, :-1], rows[:, -1] = vectors, last
    return rows


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors as rows, in their own precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and (column.null_count or len(flat) % len(column)):
        raise ValueError("vectors are missing or differ in length")
    widths = np.diff(column.offsets.to_numpy())
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1)


def _scan(questions, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(questions.value, k)
        for batch in batches:
            if batch.num_rows:
                ids = np.array(batch.column(0).to_pylist(), dtype=object)
                best.offer(ids, _matrix(batch.column(1)), batch.column(2) if batch.num_columns > 2 else None)
        if best.held.any():
            yield best.emit(TaskContext.get().partitionId() // FAN_IN)

    return scan


def _ranked(partial: DataFrame, k: int) -> DataFrame:
    """The k best of each question, first within ``part``."""
    for keys in (["qid", "part"], ["qid"]):
        order = Window.partitionBy(*keys).orderBy("dist", "document_id")
        partial = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return partial.select("qid", "rank", "document_id", "dist")


def _owners(scopes: list[str], ownership: DataFrame) -> DataFrame:
    """(document_id, owners): the places in ``scopes`` of the users who own a document. Users
    are as many as fit the broadcast questions, so a list is bounded by that."""
    places = {user: place for place, user in enumerate(scopes) if user}
    if len(places) <= FEW_USERS:  # few users reach the Parquet scan as an IN filter
        ownership = ownership.where(F.col("user_id").isin(list(places)))
    asking = ownership.sparkSession.createDataFrame(
        pa.table({"user_id": pa.array(list(places), pa.string()), "place": pa.array(list(places.values()), pa.int32())})
    )
    edges = ownership.join(F.broadcast(asking), "user_id").select("document_id", "place")
    return edges.groupBy("document_id").agg(F.collect_set("place").alias("owners"))


def _scoped(scopes: list[str], documents: DataFrame, ownership: DataFrame | None, limit: int) -> DataFrame:
    """(id, embed) of the documents that may answer, with their ``owners`` if any question
    is scoped. The vectors are scanned once, whether or not others are open."""
    if scopes == [""]:
        return documents
    if ownership is None:
        raise ValueError("questions with a user scope need the ownership table")
    # measured, as a filtered table looks as large as the whole to the optimizer
    owners, size = sizing.measured(_owners(scopes, ownership))
    owners = F.broadcast(owners) if size <= limit else owners.hint("shuffle_hash")
    how = "left" if scopes[0] == "" else "inner"
    return documents.join(owners, documents["id"] == owners["document_id"], how).select("id", "embed", "owners")


def _answer(table: pa.Table, documents: DataFrame, ownership: DataFrame | None, k: int, limit: int):
    asked = _asked(table)
    shared = documents.sparkSession.sparkContext.broadcast(asked)
    partial = _scoped(asked["scopes"], documents, ownership, limit).mapInArrow(_scan(shared, k), _PARTIAL)
    return _ranked(partial, k), shared


def nearest(
    queries: DataFrame,
    documents: DataFrame,
    k: int = K,
    ownership: DataFrame | None = None,
    broadcast_bytes: int = QUESTION_BYTES,
    owner_bytes: int = OWNER_BYTES,
) -> DataFrame:
    """``qid, rank, document_id, dist``: the ``min(k, n)`` nearest documents per question.

    ``queries(qid, embed[, user_id])``; a blank user searches everything, any other only
    what that user owns. Squared L2 in double, ties by id. ``broadcast_bytes`` is what a task
    may hold of the questions, and ``owner_bytes`` what the lists of owners may take to be
    broadcast.
    """
    return _nearest(queries, documents, k, ownership, broadcast_bytes, owner_bytes)[0]


def nearest_rows(
    queries: DataFrame,
    documents: DataFrame,
    columns: list[str],
    k: int = K,
    ownership: DataFrame | None = None,
    broadcast_bytes: int = QUESTION_BYTES,
    owner_bytes: int = OWNER_BYTES,
    few_hits: int = FEW_HITS,
) -> DataFrame:
    """``nearest`` with some columns of the documents found.

    Hits are k narrow rows per question. Up to ``few_hits`` of them are broadcast, so the
    documents are scanned for these columns but not shuffled. More of them meet the
    documents by the hash of the id: documents kept in buckets by id stay where they are,
    of others only those are exchanged that were hit (as long as the ids that were hit are
    small enough to be broadcast)."""
    hits, count = _nearest(queries, documents, k, ownership, broadcast_bytes, owner_bytes)
    found = documents.select(F.col("id").cast("string").alias("document_id"), *columns)
    if count <= few_hits:
        return F.broadcast(hits).join(found, "document_id")
    sizing.shared_dir(documents.sparkSession)
    hits = hits.checkpoint()
    wanted, size = sizing.measured(hits.select(F.col("document_id").alias("wanted")).distinct())
    if size <= owner_bytes:
        found = found.join(F.broadcast(wanted), F.col("document_id") == F.col("wanted"), "left_semi")
    return found.join(hits.hint("shuffle_hash"), "document_id")


def _nearest(queries, documents, k, ownership, broadcast_bytes, owner_bytes) -> tuple[DataFrame, int]:
    """The hits, and how many they are at most."""
    user = F.coalesce(F.col("user_id").cast("string"), F.lit("")) if "user_id" in queries.columns else F.lit("")
    asked = queries.select(F.col("qid").cast("string").alias("qid"), user.alias("scope"), "embed")
    documents = documents.select(F.col("id").cast("string").alias("id"), "embed")
    for side in (asked, documents):
        kind = side.schema["embed"].dataType
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
            raise ValueError(f"vectors are array<float> or array<double>, not {kind.simpleString()}")
    if ownership is not None:
        ownership = ownership.select(
            F.col("document_id").cast("string").alias("document_id"), F.col("user_id").cast("string").alias("user_id")
        )
    count, longest, named = asked.agg(
        F.count("*"), F.max(F.size("embed")), F.sum(F.octet_length("qid") + F.octet_length("scope"))
    ).first()
    if not count:
        none = documents.sparkSession.createDataFrame([], "qid string, rank int, document_id string, dist double")
        return none, 0
    entry = np.dtype(_ENTRIES[type(asked.schema["embed"].dataType.elementType)]).itemsize
    # the vectors as they came, and in single precision; a double is kept beside that
    total = count * (max(longest, 0) * (entry + 4) + k * CANDIDATE_BYTES) + (named or 0)
    if total > broadcast_bytes:
        each = max(1, min(broadcast_bytes, MOST_DEALT) * count // total)
        return _in_blocks(asked, documents, ownership, k, each, owner_bytes), count * k
    return _answer(asked.toArrow(), documents, ownership, k, owner_bytes)[0], count * k


def _in_blocks(asked, documents, ownership, k, each, limit) -> DataFrame:
    """The hits of questions, ``each`` of them to a partition, in one job without the driver."""
    asked, _ = sizing.measured(asked)
    scoped, opened = asked.agg(F.max(F.col("scope") != ""), F.max(F.col("scope") == "")).first()
    asked = asked.withColumn("place", F.lit(_OPEN).cast("bigint"))
    documents = documents.select("id", "embed", F.lit(None).cast("array<bigint>").alias("owners"))
    if scoped:
        if ownership is None:
            raise ValueError("questions with a user scope need the ownership table")
        users = asked.where("scope <> ''").select(F.col("scope").alias("user")).distinct()
        users, size = sizing.measured(users.withColumn("number", F.monotonically_increasing_id()))
        users = F.broadcast(users) if size <= limit else users
        asked = asked.join(users, F.col("scope") == F.col("user"), "left")
        asked = asked.select("qid", "embed", F.coalesce("number", "place").alias("place"))
        few = [r.user for r in users.select("user").limit(FEW_USERS + 1).collect()]
        if len(few) <= FEW_USERS:  # few users reach the Parquet scan as an IN filter
            ownership = ownership.where(F.col("user_id").isin(few))
        edges = ownership.join(users, F.col("user_id") == F.col("user"))
        lists = edges.groupBy("document_id").agg(F.sort_array(F.collect_set("number")).alias("owners"))
        lists, size = sizing.measured(lists)
        lists = F.broadcast(lists) if size <= limit else lists.hint("shuffle_hash")
        documents = documents.drop("owners").join(lists, documents["id"] == lists["document_id"], "left" if opened else "inner")
        documents = documents.select("id", "embed", "owners").sortWithinPartitions("owners")
    entries = [np.dtype(_ENTRIES[type(side.schema["embed"].dataType.elementType)]) for side in (asked, documents)]
    asked = _dealt(asked.select("qid", "embed", "place"), each).mapInArrow(_question_blocks, _QUESTIONS).checkpoint()
    blocks = documents.mapInArrow(_document_blocks, _DOCUMENTS).checkpoint()
    met = blocks.crossJoin(asked.hint("shuffle_replicate_nl"))  # each partition with each, a block of the left at a time
    first = F.col("number") == 0
    paired = F.array_contains("asking", F.lit(_OPEN).cast("bigint")) | F.arrays_overlap("asking", "owning")
    questions = [F.when(first, F.col(name)).alias(name) for name in ("qids", "questions", "places")]
    met = met.where(first | paired).select("source", *questions, paired.alias("paired"), *_PAIRED)
    return _ranked(met.mapInArrow(_scan_blocks(k, *entries), _PARTIAL), k)


def _dealt(asked: DataFrame, each: int) -> DataFrame:
    """The questions in the order of their places, ``each`` of them to a partition. What lies
    in a partition of a range is counted, as ranges are only about even."""
    count = asked.count()
    parts = -(-count // each)
    ranges = asked.repartitionByRange(parts, "place", "qid").sortWithinPartitions("place").checkpoint()
    at = F.monotonically_increasing_id()  # the number of the partition above the row's
    counts = ranges.select(F.shiftright(at, 33).cast("int").alias("n")).groupBy("n").count().collect()
    before = np.zeros(parts + 1, np.int64)
    before[[r["n"] + 1 for r in counts]] = [r["count"] for r in counts]
    line = F.element_at(F.array(*map(F.lit, np.cumsum(before).tolist())), (F.shiftright("at", 33) + 1).cast("int"))
    line = line + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = ranges.withColumn("at", at).withColumn("part", F.floor(line / each).cast("int"))
    return dealt.repartitionById(parts, "part").sortWithinPartitions("place").select(*asked.columns)


def _packed(schema: pa.Schema, **row) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema)


def _question_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("qids", pa.list_(pa.string())), ("questions", pa.binary()), ("places", pa.binary()), ("asking", pa.list_(pa.int64()))]
    full = [batch for batch in batches if batch.num_rows]
    if full:
        table = pa.Table.from_batches(full).combine_chunks()
        places = table.column(2).to_numpy()
        yield _packed(
            pa.schema(kinds),
            qids=table.column(0).to_pylist(),
            questions=_matrix(table.column(1).chunk(0)).tobytes(),
            places=places.tobytes(),
            asking=np.unique(places).tolist(),
        )


def _document_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("source", pa.int32()), ("number", pa.int32()), ("ids", pa.list_(pa.string())), ("width", pa.int32())]
    kinds += [(name, pa.binary()) for name in ("vectors", "filled", "firsts", "owned", "owners")]
    kinds += [("owning", pa.list_(pa.int64()))]
    full = (batch for batch in batches if batch.num_rows)
    for n, batch in enumerate(full):
        vectors, lists = _matrix(batch.column(1)), batch.column(2)
        owners = lists.flatten().to_numpy()
        entries, filled = _without_zeros(vectors)
        yield _packed(
            pa.schema(kinds),
            source=TaskContext.get().partitionId(),
            number=n,
            ids=batch.column(0).to_pylist(),
            width=vectors.shape[1],
            vectors=entries,
            filled=filled,
            firsts=_Best.distinct(vectors).tobytes(),
            owned=np.diff(lists.offsets.to_numpy()).astype(np.int64).tobytes(),
            owners=owners.tobytes(),
            owning=np.unique(owners).tolist(),
        )


def _without_zeros(vectors: np.ndarray) -> tuple[bytes, bytes]:
    """The entries in a row, and a bit for each that is not zero; the zeros are left out where
    they are most."""
    filled = vectors.view(f"u{vectors.itemsize}") != 0
    if 2 * np.count_nonzero(filled) > filled.size:
        return vectors.tobytes(), b""
    return vectors[filled].tobytes(), np.packbits(filled).tobytes()


def _with_zeros(entries: np.ndarray, filled: np.ndarray, rows: int, width: int) -> np.ndarray:
    if len(filled):
        vectors = np.zeros(rows * width, entries.dtype)
        vectors[np.flatnonzero(np.unpackbits(filled, count=rows * width).view(bool))] = entries
        entries = vectors
    return entries.reshape(rows, width)


def _scan_blocks(k: int, q_entry: np.dtype, d_entry: np.dtype):
    def asked_of(row: dict) -> tuple[dict, np.ndarray]:
        scopes, starts, counts = np.unique(np.frombuffer(row["places"], np.int64), return_index=True, return_counts=True)
        vectors = np.frombuffer(row["questions"], q_entry).reshape(len(row["qids"]), -1)
        names = ["" if scope == _OPEN else scope for scope in scopes.tolist()]
        qids = np.array(row["qids"], dtype=object)
        return {"qids": qids, "vectors": vectors, "scopes": names, "starts": starts, "counts": counts}, scopes

    def documents_of(batch: pa.RecordBatch, at: int) -> tuple:
        row = {name: batch.column(name)[at].as_buffer() for name in ("vectors", "filled", "firsts", "owned", "owners")}
        ids = np.array(batch.column("ids")[at].values.to_pylist(), dtype=object)
        entries, filled = np.frombuffer(row["vectors"], d_entry), np.frombuffer(row["filled"], np.uint8)
        vectors = _with_zeros(entries, filled, len(ids), batch.column("width")[at].as_py())
        return ids, vectors, *(np.frombuffer(row[name], np.int64) for name in ("firsts", "owned", "owners"))

    def owned_of(lengths: np.ndarray, owners: np.ndarray, scopes: np.ndarray) -> pa.ListArray:
        """Of each document the places, in a block of questions, of the scopes that own it."""
        places = np.searchsorted(scopes, owners)
        here = scopes[np.minimum(places, len(scopes) - 1)] == owners
        each = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[here], minlength=len(lengths))
        offsets = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(places[here].astype(np.int32)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, source, scopes = None, 0, None
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("qids")[at].is_valid:
                    asked, scopes = asked_of({name: batch.column(name)[at].as_py() for name in ("qids", "questions", "places")})
                    best, source = _Best(asked, k), batch.column("source")[at].as_py()
                if batch.column("paired")[at].as_py():
                    ids, vectors, firsts, lengths, owners = documents_of(batch, at)
                    best.offer(ids, vectors, owned_of(lengths, owners, scopes), firsts)
        if best is not None and best.held.any():
            yield best.emit(source // FAN_IN)

    return scan
