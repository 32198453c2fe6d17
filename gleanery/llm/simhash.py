"""Near-duplicates by SimHash fingerprints, compared in bit slices.

A bit of a fingerprint is set where over half of the hashes of a document's word shingles
have it set. Documents of equal fingerprints form a class, and everything below works on
classes. Two fingerprints link where at most ``RADIUS`` of their 64 bits differ.

Links are found among fingerprints that agree in six of their eight bytes: two that differ
in two bits or fewer differ in two bytes at most, so one of the 28 choices of six bytes
brings them together, and no link is lost. Within such a bucket only 16 bits are free. It
holds at most 65,536 different fingerprints, whatever the corpus, which bounds a group's
memory and its comparisons, and at most 136 of them lie within two bits of a given one.

A bucket's free bits are stored vertically: a plane for each bit, 64 fingerprints to a word.
A fingerprint is compared with a word of 64 others at once: plane by plane the differing
bits are added by carry-save counters of two bits and an overflow, and a block whose
fingerprints have all exceeded the radius is abandoned. A bucket gives a spanning forest of
its links, not all of them.

Null and empty texts, and such without words, have fingerprint zero, which links like any
other. A row without an id has a fingerprint and links; its component is the smallest id
reachable, null if there is none. Rows that repeat an id are judged one by one. Ties do not
arise: a bit set in exactly half of the hashes is zero. Texts of any length are hashed in
pieces of about ``PIECE`` bytes. An empty table gives an empty one. Other columns are not
carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gleanery.llm.near_dedup import components
from gleanery.llm.texts import merge_labels, raw
from gleanery.operators.sizing import broadcast_if_small
from gleanery.session import shared_dir

SHINGLE = 3  # words
SEED = 42  # of XXH64
RADIUS = 2  # bits, within what two counter bits can tell
PIECE = 1 << 20  # bytes of text split into words at once
ROWS = 1 << 16  # fingerprints gathered before their complete buckets are compared
BLOCKS = 1 << 17  # pairs of a fingerprint and a word compared at once
HOT = 100_000  # documents of one fingerprint from which they are joined by broadcast

FREE = list(combinations(range(8), 2))  # the bytes that may differ
_ALL = (1 << 64) - 1
_FIXED = [_ALL & ~(0xFF << 8 * i) & ~(0xFF << 8 * j) for i, j in FREE]
_LOW = np.array([8 * i for i, _ in FREE], np.uint64)
_HIGH = np.array([8 * j for _, j in FREE], np.uint64)
_MASK = np.array(_FIXED, np.uint64)
_FULL = np.uint64(_ALL)
_digest = partial(xxhash.xxh64_intdigest, seed=SEED)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """The text cut at white space into pieces of about ``limit`` bytes."""
    begin = 0
    while len(text) - begin > limit and (space := _SPACE.search(text, begin + limit)):
        yield text[begin : space.start()]
        begin = space.start()
    yield text[begin:]


def shingle_hashes(text: bytes, shingle: int = SHINGLE, limit: int = PIECE) -> Iterator[np.ndarray]:
    """Hashes of every run of ``shingle`` words; of all words where there are fewer."""
    carried: list[bytes] = []
    hashed = False
    for piece in _pieces(text, limit):
        words = carried + piece.lower().split()
        if len(words) >= shingle:
            runs = zip(*[islice(words, i, None) for i in range(shingle)])
            yield np.fromiter(map(_digest, map(b" ".join, runs)), np.uint64, len(words) - shingle + 1)
            hashed = True
            words = words[len(words) - shingle + 1 :]
        carried = words
    if carried and not hashed:
        yield np.array([_digest(b" ".join(carried))], np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE, limit: int = PIECE) -> int:
    """The fingerprint as a signed number."""
    n, votes = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle, limit):
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a bigint."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())

    return of(text)


def _beyond(over: np.ndarray, ones: np.ndarray, twos: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose counters exceed the radius."""
    return over | ((ones | twos, twos, ones & twos)[radius])


def _near(free: np.ndarray, planes: np.ndarray, valid: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int):
    """(query, lane) of the lanes of each word within the radius of its query."""
    over, ones, twos = ~valid[word], np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
    bits = free[query]
    for p in range(16):
        differ = planes[p][word] ^ (np.uint64(0) - ((bits >> np.uint16(p)) & np.uint16(1)).astype(np.uint64))
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if p % 4 == 3:  # abandon the blocks that have nothing left
            live = _beyond(over, ones, twos, radius) != _FULL
            query, word, bits, over, ones, twos = (x[live] for x in (query, word, bits, over, ones, twos))
    near = ~_beyond(over, ones, twos, radius)
    row, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[row], word[row] * 64 + lane


def bucket_forest(group: np.ndarray, free: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) positions of a spanning forest of each group's links. Rows come by
    group; ``free`` are the 16 bits in which a group's fingerprints may differ."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    words = (sizes + 63) // 64
    first_word = np.cumsum(words) - words
    lane = np.repeat(first_word * 64 - starts, sizes) + np.arange(len(group))
    lanes, member = np.zeros(words.sum() * 64, np.uint16), np.full(words.sum() * 64, -1)
    lanes[lane], member[lane] = free, np.arange(len(group))
    planes = [np.packbits((lanes >> p) & 1, bitorder="little").view(np.uint64) for p in range(16)]
    valid = np.packbits(member >= 0, bitorder="little").view(np.uint64)
    # a fingerprint meets its own word and the later ones of its group
    own, last = lane // 64, np.repeat(first_word + words, sizes)
    due = last - own
    labels = np.arange(len(group))
    begin = 0
    total = np.cumsum(due)
    while begin < len(group):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + BLOCKS, "right")))
        n = due[begin:end]
        query = np.repeat(np.arange(begin, end), n)
        word = np.repeat(own[begin:end] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        a, b = _near(free, planes, valid, query, word, radius)
        labels = merge_labels(labels, a, member[b])
        begin = end
    linked = np.flatnonzero(labels != np.arange(len(group)))
    return linked, labels[linked]


def _links(radius: int):
    """Forest edges (a, b) of a task's buckets; rows (choice, fp) come by bucket."""

    def edges(choice: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        at = choice.astype(np.int64)
        key = fp & _MASK[at]
        same = np.r_[False, (key[1:] == key[:-1]) & (at[1:] == at[:-1])]
        shared = same | np.r_[same[1:], False]  # buckets of one are done
        group = np.cumsum(~same)[shared]
        at, fp = at[shared], fp[shared]
        free = ((fp >> _LOW[at]) & np.uint64(0xFF)) | (((fp >> _HIGH[at]) & np.uint64(0xFF)) << np.uint64(8))
        if len(fp):
            member, root = bucket_forest(group, free.astype(np.uint16), radius)
        else:
            member = root = np.empty(0, np.int64)
        columns = [pa.array(fp[member].view(np.int64)), pa.array(fp[root].view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            waiting += batch.num_rows
            if waiting < ROWS:
                continue
            choice, fp = (np.concatenate(c) for c in zip(*parts))
            # the last bucket may go on in the next batch
            last = (choice == choice[-1]) & ((fp ^ fp[-1]) & _MASK[choice[-1]] == 0)
            whole = len(fp) - int(last.sum())
            if whole:
                yield edges(choice[:whole], fp[:whole])
            parts, waiting = [(choice[whole:], fp[whole:])], len(fp) - whole
        if waiting:
            yield edges(*(np.concatenate(c) for c in zip(*parts)))

    return links


def fingerprint_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) edges that join the different fingerprints ``fp`` within the radius."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"a radius of at most {RADIUS} bits is brought together by six bytes of eight")
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in _FIXED])
    dealt = classes.select(F.explode(F.array(*[F.lit(c).cast("tinyint") for c in range(len(FREE))])).alias("choice"), "fp")
    bucket = F.col("fp").bitwiseAND(F.element_at(signed, F.col("choice").cast("int") + 1))
    dealt = dealt.repartition("choice", bucket).sortWithinPartitions("choice", bucket)
    return dealt.mapInArrow(_links(radius), "a bigint, b bigint")


def simhash_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    shared_dir(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), fingerprints(raw(text), shingle).alias("fp")).checkpoint()
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).checkpoint()
    edges = fingerprint_links(classes, radius).checkpoint()
    component = classes.select("fp", "n", F.col("first").alias("component_id"))
    if not edges.isEmpty():
        placed = classes.join(components(edges), F.col("fp") == F.col("node"))
        least = placed.groupBy("root").agg(F.min("first").alias("least"))
        moved = placed.join(least, "root").select("fp", "least")
        component = classes.join(moved, "fp", "left").select("fp", "n", F.coalesce("least", "first").alias("component_id"))
    component = component.checkpoint()
    # a fingerprint of very many documents is not gathered in one task
    often = broadcast_if_small(component.where(F.col("n") > HOT))
    rest = rows.join(often, "fp", "left_anti").join(component.where(F.col("n") <= HOT), "fp")
    found = rows.join(often, "fp").select("doc_id", "fp", "component_id").union(rest.select("doc_id", "fp", "component_id"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
