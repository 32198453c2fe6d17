"""Deduplication of substrings: removing byte strings that an earlier document holds.

Every byte covered by a ``LENGTH``-byte string that also starts in a document of smaller id
is removed; the first document keeps its copy. Strings are judged on the input.

Ordering all suffixes of a corpus would move ``LENGTH`` bytes for each of its bytes. So the
suffixes are sampled by content: in each string of ``LENGTH`` bytes the ``GRAM`` bytes of
least hash are its anchor, the same in every copy of the string. An anchor's context, the
``REACH`` bytes before it and ``LENGTH`` after its start, holds all strings that it is the
anchor of. Four steps:

1. A task finds its documents' anchors. Of anchors with one context, all but the smallest
   document's are repeats already; the others go on, packed, to a bucket by the anchor.
2. A bucket finds the smallest document of each context, and the later ones are repeats.
   Anchors left with different contexts may share a part of these: their bytes are asked
   for, once for each different context.
3. The documents asked deliver these contexts.
4. A bucket puts the strings of ``LENGTH`` bytes of its contexts in order, equal ones by
   document, and compares each document with the first of its run. No suffix array and no
   longest previous factors are computed: whether a string stands earlier is all that is asked.

Beside a passage that many documents hold, each document has a context of its own, so one
anchor has as many contexts as there are documents. No such anchor is gathered: a task that
finds more than a crowd of them deals them by context instead, with a mark for the anchor's
bucket, and all contexts of a marked anchor are asked for. Step 4 does not put these in
order: their strings of ``LENGTH`` bytes are grouped, the bytes themselves as the key, for
the smallest document, which combines within tasks; strings that stand in very many contexts
meet them by broadcast.

Contexts are held equal in steps 1 and 2 by all 64 bits of their hash, beside the anchor's
(whose bits tell nothing among the contexts of one anchor): of N different contexts of an
anchor N * N / 2^65 pairs are expected to be confused, 3e-6 for ten million. Step 4 compares
bytes. The number of buckets follows the size of the texts.

A null text is empty. Rows without an id are left as they are, and are not earlier than any
other. Rows that share an id are not earlier than one another. Without rows nothing is
returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanery.llm.texts import BASE, CHUNK_BYTES, MASK, chunks, mix, raw
from gleanery.operators.sizing import broadcast_if_small
from gleanery.session import shared_dir

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM
BUCKET_BYTES = 12 << 20  # of text for each bucket
FLUSH = 400_000  # anchors gathered in a task before they are handed on
DELIVERED = 150_000  # contexts likewise
FLUSH_DOCS = 60_000  # fit 16 bits
CROWD = 64  # contexts of an anchor in one flush beyond which they are dealt by context
GATHERED = 4096  # contexts of an anchor that step 4 puts in order at once
CROWDED_BYTES = 100 << 30  # of text, from which on a crowd is fewer, so that buckets stay bounded
COMMON = 20_000  # strings at most that meet their contexts by broadcast
MARGIN = 2 * LENGTH

_BACK = np.uint64(pow(BASE, -1, MASK + 1))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_LOW = np.uint64((1 << 24) - 1)

BLOBS = "bucket int, kind int, ids binary, hashes binary, data binary"
FOUND = "doc_id bigint, hash int, at int, anchor bigint, crowded boolean, whole binary"
PARTS = "doc_id bigint, hash int, start bigint, end bigint"


class Powers:
    def __init__(self, n: int):
        self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE, np.uint64)]))
        self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BACK, np.uint64)]))


def pieces(text: bytes, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, bytes, int, int]]:
    """(offset, bytes, first, last): parts of a text; strings starting in [first, last) of
    the part are its own, and the bytes reach as far as their contexts."""
    if len(text) <= limit:
        yield 0, text, 0, len(text)
        return
    for a in range(0, len(text), limit):
        low, high = max(0, a - MARGIN), min(len(text), a + limit + MARGIN)
        yield low, text[low:high], a - low, min(a + limit, len(text)) - low


def anchors(parts: list[tuple[bytes, int, int]], powers: Powers) -> tuple[np.ndarray, ...]:
    """(part, position, anchor hash, context hash) of the anchors in some parts."""
    lengths = np.array([len(p[0]) for p in parts], np.int64)
    flat = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
    n = len(flat)
    empty = np.empty(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[flat] * powers.up[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers.down[: n - GRAM + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    least = (grams & ~_LOW) | (place & _LOW)
    for step in (1, 2, 4, 8):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: n - LENGTH + 1], least[REACH + 1 - 16 :][: n - LENGTH + 1])
    starts = np.concatenate(
        [np.arange(b + first, max(b + first, min(b + last, e - LENGTH + 1))) for b, e, (_, first, last) in zip(begins, ends, parts)]
    )
    if not len(starts):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    low = starts.astype(np.uint64)
    at = (low + (((least[starts] & _LOW) - low) & _LOW)).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    part = np.searchsorted(ends, at, side="right")
    left, right = np.maximum(at - REACH, begins[part]), np.minimum(at + LENGTH, ends[part])
    context = mix((sums[right] - sums[left]) * powers.down[left])
    context = mix(context + (at - left).astype(np.uint64) * np.uint64(256) + (right - at).astype(np.uint64))
    return part, at - begins[part], grams[at], context


def heads(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def runs_least(head: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least value of each row's run."""
    return np.minimum.reduceat(values, np.flatnonzero(head))[np.cumsum(head) - 1] if len(values) else values


def names(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """What anchors are told apart by: their buckets and lower halves."""
    bucket = (anchor >> np.uint64(32)) % np.uint64(buckets)
    return (bucket << np.uint64(32)) | (anchor & np.uint64(0xFFFFFFFF))


class Gatherer:
    """Anchors of a task's documents, packed by bucket: those to be compared (kind 0) and
    known repeats (1). Anchors of more than ``crowd`` entries go by context (3), each with
    one entry as a mark in its own bucket (4)."""

    def __init__(self, buckets: int, crowd: int = CROWD):
        self.buckets, self.crowd, self.powers = buckets, crowd, Powers(CHUNK_BYTES + 4 * MARGIN)
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[int, int]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, docs: list[tuple[int, int, bytes]]) -> None:
        some, whose, offsets = [], [], []
        for doc, hash, text in docs:
            for offset, piece, first, last in pieces(text):
                some.append((piece, first, last))
                whose.append(len(self.docs))
                offsets.append(offset)
            self.docs.append((doc, hash))
        done = 0
        for a, b in chunks([p[0] for p in some], CHUNK_BYTES):
            part, at, anchor, context = anchors(some[a:b], self.powers)
            part = part + done
            place = (at + np.array(offsets, np.int64)[part]).astype(np.uint32)
            self.parts.append((np.array(whose, np.int32)[part], place, anchor, context))
            self.n += len(at)
            done = b

    def packed(self) -> Iterator[tuple]:
        if not self.n:
            self.clear()
            return
        ids = np.array([d[0] for d in self.docs], np.int64)
        hashes = np.array([d[1] for d in self.docs], np.int32)
        ref, at, anchor, context = (np.concatenate(x) for x in zip(*self.parts))
        self.clear()  # only one copy of the anchors is held beside those put in order
        order = np.lexsort((ids[ref], context, anchor))
        ref, at, anchor, context = ref[order], at[order], anchor[order], context[order]
        del order
        owner = ids[ref]
        first = owner == runs_least(heads(anchor, context), owner)
        del owner
        name = names(anchor, self.buckets)
        bucket = (name >> np.uint64(32)).astype(np.int64)
        group = np.cumsum(heads(anchor)) - 1
        crowded = first & (np.bincount(group[first], minlength=group[-1] + 1) > self.crowd)[group]
        mark = np.zeros(len(name), bool)
        mark[np.flatnonzero(crowded)[heads(group[crowded])]] = True
        dealt = (mix(anchor ^ mix(context)) % np.uint64(self.buckets)).astype(np.int64)
        for kind, chosen, to in ((0, first & ~crowded, bucket), (1, ~first, ref % self.buckets), (3, crowded, dealt), (4, mark, bucket)):
            rows = np.flatnonzero(chosen)
            rows = rows[np.argsort(to[rows], kind="stable")]
            for own in np.split(rows, np.flatnonzero(np.diff(to[rows])) + 1):
                if not len(own):
                    continue
                docs, small = np.unique(ref[own], return_inverse=True)
                data = [small.astype(np.uint16), at[own].astype(np.uint16), (at[own] >> 16).astype(np.uint16)]
                if kind != 1:
                    data += [name[own] if kind == 3 else name[own].astype(np.uint32), context[own]]
                yield int(to[own[0]]), kind, ids[docs].tobytes(), hashes[docs].tobytes(), b"".join(d.tobytes() for d in data)


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "ids", "hashes", "data"])


def _gather(buckets: int, crowd: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gatherer = Gatherer(buckets, crowd)
        for batch in batches:
            docs = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for a, b in chunks([d[2] for d in docs]):
                gatherer.add(docs[a:b])
                if gatherer.n >= FLUSH or len(gatherer.docs) >= FLUSH_DOCS:
                    yield from handed_on(gatherer.packed())
        yield from handed_on(gatherer.packed())

    return gather


def handed_on(rows: Iterator[tuple], at_once: int = 64) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == at_once:
            yield _blobs(some)
            some = []
    if some:
        yield _blobs(some)


def unpacked(table: pa.Table, kind: int) -> list[np.ndarray]:
    """id, hash, position, and for anchors the anchor and the context; of one kind."""
    table = table.filter(pa.compute.equal(table["kind"], kind))
    types = [np.uint16, np.uint16, np.uint16] + ([] if kind == 1 else [np.uint64 if kind == 3 else np.uint32, np.uint64])
    out: list[list[np.ndarray]] = [[] for _ in types]
    for ids, hashes, data in zip(*(table[c].to_pylist() for c in ("ids", "hashes", "data"))):
        n, offset, fields = len(data) // sum(np.dtype(t).itemsize for t in types), 0, []
        for t in types:
            fields.append(np.frombuffer(data, t, n, offset))
            offset += n * np.dtype(t).itemsize
        at = fields[1].astype(np.uint32) | (fields[2].astype(np.uint32) << np.uint32(16))
        for x, values in zip(out, [np.frombuffer(ids, np.int64)[fields[0]], np.frombuffer(hashes, np.int32)[fields[0]], at, *fields[3:]]):
            x.append(values)
    kinds = [np.int64, np.int32, np.uint32, *types[3:]]
    return [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, kinds)]


def _settle(key: tuple, table: pa.Table) -> pa.Table:
    """Step 2: repeated contexts of one bucket, and the contexts whose bytes are asked for."""
    local = unpacked(table, 1)
    own = np.uint64(key[0].as_py()) << np.uint64(32)
    plain, dealt = unpacked(table, 0), unpacked(table, 3)
    plain[3], dealt[3] = own | plain[3].astype(np.uint64), dealt[3].astype(np.uint64)
    marked = own | unpacked(table, 4)[3].astype(np.uint64)
    crowded = np.concatenate([np.isin(plain[3], marked), np.ones(len(dealt[3]), bool)])
    ids, hashes, at, name, context = (np.concatenate(x) for x in zip(plain, dealt))
    order = np.lexsort((ids, context, name))
    ids, hashes, at, name, context, crowded = (x[order] for x in (ids, hashes, at, name, context, crowded))
    repeat = ids != runs_least(heads(name, context), ids)
    group = np.cumsum(heads(name)) - 1
    n = group[-1] + 1 if len(group) else 0
    firsts = ids[~repeat]
    least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, group[~repeat], firsts)
    np.maximum.at(most, group[~repeat], firsts)
    asked = ~repeat & (crowded | (least < most)[group])
    # all of an anchor is here, or it is crowded everywhere
    crowded |= (np.bincount(group[asked], minlength=n) > GATHERED)[group]
    # a row for each anchor found here: their number follows the texts, not the buckets
    single = pa.table(
        {
            "doc_id": np.concatenate([ids[repeat], ids[asked]]),
            "hash": np.concatenate([hashes[repeat], hashes[asked]]),
            "at": np.concatenate([at[repeat], at[asked]]).astype(np.int32),
            "anchor": pa.array(
                np.concatenate([np.zeros(int(repeat.sum()), np.uint64), name[asked]]).view(np.int64),
                mask=np.arange(int(repeat.sum() + asked.sum())) < repeat.sum(),
            ),
            "crowded": np.concatenate([np.zeros(int(repeat.sum()), bool), crowded[asked]]),
            "whole": pa.nulls(int(repeat.sum() + asked.sum()), pa.binary()),
        }
    )
    # and one for each document whose repeats its task knew
    order = np.lexsort((local[1], local[0]))
    doc, hash, place = (x[order] for x in local)
    cuts = np.flatnonzero(heads(doc, hash))
    together = pa.table(
        {
            "doc_id": doc[cuts].astype(np.int64),
            "hash": hash[cuts].astype(np.int32),
            "at": pa.nulls(len(cuts), pa.int32()),
            "anchor": pa.nulls(len(cuts), pa.int64()),
            "crowded": np.zeros(len(cuts), bool),
            "whole": pa.array([place[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(doc)))], pa.binary()),
        }
    )
    return pa.concat_tables([single, together])


WIDTH = REACH + LENGTH


def _deliver(buckets: int):
    """Step 3: the contexts asked for, by bucket of their anchor."""

    def packed(rows: list[tuple]) -> Iterator[tuple]:
        if not rows:
            return
        ids, hashes = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32)
        ref = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        at, name = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
        sides, bytes_ = np.concatenate([r[4] for r in rows]), np.concatenate([r[5] for r in rows])
        to = (mix(name) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
            data = [at[own].astype(np.uint32), name[own], sides[own], bytes_[own]]
            yield int(to[own[0]]), 2, ids[ref[own]].tobytes(), hashes[ref[own]].tobytes(), b"".join(d.tobytes() for d in data)

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            for doc, hash, text, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
                at = np.array([x["at"] for x in asked], np.int64)
                name = np.array([x["anchor"] for x in asked], np.int64).view(np.uint64)
                padded = np.frombuffer(bytes(REACH) + text + bytes(LENGTH), np.uint8)
                bytes_ = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at]
                sides = np.stack([np.minimum(at, REACH), np.minimum(len(text) - at, LENGTH)], axis=1).astype(np.uint8)
                rows.append((doc, hash, at, name, sides, bytes_))
                n += len(at)
                if n >= DELIVERED:
                    yield from handed_on(packed(rows))
                    rows, n = [], 0
        yield from handed_on(packed(rows))

    return deliver


def earlier(ids: np.ndarray, name: np.ndarray, sides: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    """[context, shift]: whether the string that starts ``shift`` bytes before the anchor
    stands in an earlier document too."""
    n = len(ids)
    shift = np.tile(np.arange(REACH + 1, dtype=np.uint8), n)
    row = np.repeat(np.arange(n), REACH + 1)
    inside = (shift <= sides[row, 0]) & (LENGTH - shift <= sides[row, 1])
    row, shift = row[inside], shift[inside]
    strings = np.zeros((len(row), 56), np.uint8)
    strings[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(bytes_, LENGTH, axis=1)[row, REACH - shift.astype(np.int64)]
    words = strings.view(">u8").astype(np.uint64)
    columns = [words[:, i] for i in range(words.shape[1])]
    order = np.lexsort((ids[row], *columns[::-1], shift, name[row]))
    head = heads(name[row][order], shift[order], *[c[order] for c in columns])
    smaller = np.zeros((n, REACH + 1), bool)
    smaller[row[order], shift[order]] = ids[row[order]] > runs_least(head, ids[row[order]])
    return smaller


def _order(table: pa.Table) -> pa.Table:
    """Step 4, for the contexts of a bucket; all of an anchor's at once, ``GATHERED`` at most."""
    lists: list[list] = [[] for _ in range(6)]
    for ids, hashes, data in zip(*(table[c].to_pylist() for c in ("ids", "hashes", "data"))):
        n, offset = len(ids) // 8, 0
        for i, (t, width) in enumerate(((np.int64, 1), (np.int32, 1), (np.uint32, 1), (np.uint64, 1), (np.uint8, 2), (np.uint8, WIDTH))):
            source = (ids, hashes, data, data, data, data)[i]
            values = np.frombuffer(source, t, n * width, offset if i >= 2 else 0)
            offset += values.nbytes if i >= 2 else 0
            lists[i].append(values.reshape(n, width) if width > 1 else values)
    ids, hashes, at, name, sides, bytes_ = (np.concatenate(x) for x in lists)
    order = np.argsort(name, kind="stable")
    ids, hashes, at, name, sides, bytes_ = (x[order] for x in (ids, hashes, at, name, sides, bytes_))
    begins = np.append(np.flatnonzero(heads(name)), len(name))
    starts, stops, rows = [], [], []
    a = 0
    while a < len(begins) - 1:
        b = max(a + 1, int(np.searchsorted(begins, begins[a] + 8192, side="right")) - 1)
        low, high = begins[a], begins[b]
        found = earlier(ids[low:high], name[low:high], sides[low:high], bytes_[low:high])
        some = np.flatnonzero(found.any(axis=1))
        far = REACH - found[some, ::-1].argmax(axis=1)
        near = found[some].argmax(axis=1)
        rows.append(some + low)
        starts.append(at[some + low].astype(np.int64) - far)
        stops.append(at[some + low].astype(np.int64) - near + LENGTH)
        a = b
    rows_ = np.concatenate(rows)
    return pa.table({"doc_id": ids[rows_], "hash": hashes[rows_], "start": np.concatenate(starts), "end": np.concatenate(stops)})


def _shared(judged: DataFrame, asked: DataFrame) -> DataFrame:
    """Steps 3 and 4 for the contexts of crowded anchors: their strings, grouped."""
    asked = broadcast_if_small(asked.groupBy("doc_id", "hash").agg(F.collect_list("at").alias("asked")))
    begin = lambda at: F.greatest(at - REACH, F.lit(0))
    context = lambda at: F.struct(begin(at).alias("begin"), at.alias("at"), F.substring("bytes", begin(at) + 1, at + LENGTH - begin(at)).alias("piece"))
    contexts = judged.join(asked, ["doc_id", "hash"]).select("doc_id", "hash", F.transform("asked", context).alias("c"))
    contexts = contexts.select("doc_id", "hash", F.explode("c").alias("c")).select("doc_id", "hash", "c.*").checkpoint()
    shifts = F.sequence(F.lit(0), F.length("piece") - LENGTH)
    strings = contexts.where(F.length("piece") >= LENGTH).withColumn("i", F.explode(shifts))
    strings = strings.select("doc_id", "hash", "at", (F.col("begin") + F.col("i")).alias("start"), F.substring("piece", F.col("i") + 1, F.lit(LENGTH)).alias("string"))
    known = strings.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    known = known.where("least < most").select("string", "least", "n").checkpoint()
    often = max(1000, (known.agg(F.sum("n")).first()[0] or 0) // COMMON)
    common = F.broadcast(known.where(F.col("n") > often).drop("n"))  # COMMON rows at most
    others = strings.join(common, "string", "left_anti").join(known.where(F.col("n") <= often).drop("n"), "string")
    later = strings.join(common, "string").unionByName(others).where(F.col("doc_id") > F.col("least"))
    parts = later.groupBy("doc_id", "hash", "at").agg(F.min("start").alias("start"), F.max("start").alias("last"))
    return parts.select("doc_id", "hash", F.col("start").cast("bigint"), (F.col("last") + LENGTH).cast("bigint").alias("end"))


def removed(n: int, single: list[int], whole: list[bytes], parts: list[dict]) -> list[tuple[int, int]]:
    """Maximal covered runs of a text of n bytes."""
    at = np.concatenate([np.array(single, np.int64), *[np.frombuffer(x, np.uint32).astype(np.int64) for x in whole]])
    starts = np.concatenate([np.maximum(at - REACH, 0), np.array([p["start"] for p in parts], np.int64)])
    stops = np.concatenate([np.minimum(at + LENGTH, n), np.array([p["end"] for p in parts], np.int64)])
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    first = np.concatenate([[True], starts[1:] > stops[:-1]])
    return list(zip(starts[first].tolist(), stops[np.append(np.flatnonzero(first)[1:] - 1, len(stops) - 1)].tolist()))


def _remover():
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kind = pa.struct([("spans", span), ("kept", pa.binary())])

    @F.arrow_udf("struct<spans:array<struct<start:bigint,end:bigint>>,kept:binary>")
    def remove(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            rows = []
            for text, single, whole, part in zip(*(c.to_pylist() for c in columns)):
                spans, kept, at = removed(len(text), single or [], whole or [], part or []), [], 0
                for start, end in spans:
                    kept.append(text[at:start])
                    at = end
                rows.append({"spans": [{"start": s, "end": e} for s, e in spans], "kept": b"".join([*kept, text[at:]])})
            yield pa.array(rows, kind)

    return remove


def remove_repeats(docs: DataFrame, text: str = "text", crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every document: the byte spans removed, and the
    remaining bytes one after another. ``crowd`` changes the work's shape, not its result."""
    shared_dir(docs.sparkSession)
    docs = docs.select("doc_id", F.hash(raw(text)).alias("hash"), raw(text).alias("bytes"))
    judged = docs.where("doc_id is not null")
    size = judged.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    blobs = judged.where(F.length("bytes") >= LENGTH).mapInArrow(_gather(buckets, min(crowd, max(4, CROWD * CROWDED_BYTES // max(size, 1)))), BLOBS)
    found = blobs.groupBy("bucket").applyInArrow(_settle, FOUND).checkpoint()
    named = found.where("anchor is not null")
    asked = named.where("not crowded").groupBy("doc_id", "hash").agg(F.collect_list(F.struct("at", "anchor")).alias("asked"))
    # the texts meet what is known of them twice, by one exchange that Spark uses again
    asked = judged.join(asked.hint("shuffle_merge"), ["doc_id", "hash"]).select("doc_id", "hash", "bytes", "asked")
    ordered = asked.mapInArrow(_deliver(buckets), BLOBS).groupBy("bucket").applyInArrow(_order, PARTS)
    whole = found.where("anchor is null").select("doc_id", "hash", "at", "whole")
    crowded = named.where("crowded").select("doc_id", "hash", "at")
    if not crowded.isEmpty():
        ordered = ordered.unionByName(_shared(judged, crowded))
    parts = ordered.select("doc_id", "hash", F.struct("start", "end").alias("part"))
    covers = whole.unionByName(parts, allowMissingColumns=True).groupBy("doc_id", "hash")
    covers = covers.agg(*[F.collect_list(c).alias(c) for c in ("at", "whole", "part")])
    joined = judged.join(covers.hint("shuffle_merge"), ["doc_id", "hash"], "left").select("doc_id", "bytes", "at", "whole", "part")
    nameless = docs.where("doc_id is null").select("doc_id", "bytes")
    joined = joined.unionByName(nameless, allowMissingColumns=True)
    result = joined.select("doc_id", F.length("bytes").cast("bigint").alias("n_bytes"), _remover()("bytes", "at", "whole", "part").alias("r"))
    return result.select("doc_id", "n_bytes", "r.spans", "r.kept")
