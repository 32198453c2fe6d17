"""Byte-level BPE encoding and decoding with DuckDB's recursive queries in each task.

A text is split by the pattern, and each distinct piece is encoded once for a run of
documents. Its bytes are token-position rows; a recursive query joins neighbouring tokens
with the merge table and contracts each piece's leftmost pair of least rank, until no pair
of any piece is left. A piece that is a token itself is not merged. Decoding joins ids with
the tokens' bytes and concatenates them in order of position, ``QUERY_IDS`` at a time; the
bytes of a longer text's slices follow one another.

Pieces beyond ``QUERY_BYTES`` would take as many rounds of the query as they have merges,
each over all their rows; they are contracted by the same rule with a heap instead.

A null text is an empty one: no ids, no bytes. Rows are encoded one by one, repeated or
not, and no length is cut off. Without rows nothing is returned.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from gleanery.llm.texts import chunks

QUERY_BYTES = 64  # longest piece that the recursive query takes
REMEMBERED = 250_000  # pieces kept from one run of documents to the next
QUERY_ROWS = 2 << 20  # that the pieces of one query can leave in all its rounds, about 50 bytes each
QUERY_IDS = 1 << 18  # decoded in one query
DUCKDB_MEMORY = "256MB"
RUN_BYTES = 1 << 20  # of text encoded at once

ENCODED = "struct<ids:array<int>,decoded:binary>"

# A row of the state: the token of a piece that starts at byte pos, its length, the next
# token and its length, and the two as a pair: rank * 1024 + pos, null where they are none.
# A step merges each piece's least pair: the row at pos takes both tokens, that at gone goes,
# and the one before pos gets a new neighbour.
_MERGE = """
WITH RECURSIVE state AS (
    SELECT s.piece, s.pos, s.id, s.len, n.id AS next_id, n.len AS next_len, m.rank * 1024 + s.pos AS pair, 0 AS step
    FROM start s
    LEFT JOIN start n ON n.piece = s.piece AND n.pos = s.pos + s.len
    LEFT JOIN merges m ON m.l = s.id AND m.r = n.id
    UNION ALL (
    WITH least AS MATERIALIZED (
        SELECT l.piece, l.rank AS id, l.pos, l.gone, g.pos + g.len - l.pos AS len, g.next_id, g.next_len
        FROM (
            SELECT piece, (min(pair) // 1024)::INTEGER AS rank, (min(pair) % 1024)::INTEGER AS pos, arg_min(pos + len, pair) AS gone
            FROM state GROUP BY piece HAVING min(pair) IS NOT NULL
        ) l
        JOIN state g ON g.piece = l.piece AND g.pos = l.gone
    )
    SELECT s.piece, s.pos, s.id, s.len, s.next_id, s.next_len, CASE WHEN s.changed THEN m.rank * 1024 + s.pos ELSE s.pair END, s.step
    FROM (
        SELECT s.piece, s.pos, s.step + 1 AS step, s.pair,
            CASE WHEN s.pos = l.pos THEN l.id ELSE s.id END AS id,
            CASE WHEN s.pos = l.pos THEN l.len ELSE s.len END AS len,
            CASE WHEN s.pos = l.pos THEN l.next_id WHEN s.pos + s.len = l.pos THEN l.id ELSE s.next_id END AS next_id,
            CASE WHEN s.pos = l.pos THEN l.next_len WHEN s.pos + s.len = l.pos THEN l.len ELSE s.next_len END AS next_len,
            s.pos = l.pos OR s.pos + s.len = l.pos AS changed
        FROM state s JOIN least l ON l.piece = s.piece WHERE s.pos != l.gone
    ) s LEFT JOIN merges m ON m.l = s.id AND m.r = s.next_id)
)
SELECT piece, id
FROM state JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) USING (piece, step)
ORDER BY piece, pos
"""
_DECODE = "SELECT doc, array_to_string(list(t.hex ORDER BY i.pos), '') FROM ids i JOIN tokens t USING (id) GROUP BY doc"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its count, one range after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - begins, counts)


class Slots(dict):
    """Numbers of pieces, in order of their first use."""

    def __missing__(self, piece: str) -> int:
        self[piece] = slot = len(self)
        return slot


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.find = regex.compile(pattern).findall
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        halves = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        columns = dict(zip(("l", "r", "rank"), np.array(halves, np.int32).T.copy()))
        self._fill("merges", "SELECT l, r, rank::BIGINT AS rank FROM given", columns)
        tokens = {"id": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]}
        self._fill("tokens", "SELECT id::INTEGER AS id, hex FROM given", tokens)
        self.slots = Slots()
        # ids of the pieces in order of their slots, and how many each has
        self.flat, self.counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]

    @functools.cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        return {(l, r): rank for l, r, rank in self.db.execute("SELECT l, r, rank FROM merges").fetchall()}

    def _fill(self, name: str, query: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS {query}")
        self.db.unregister("given")

    def _forget(self, here: set[str]) -> None:
        """Keep the pieces of the texts at hand, the frequent ones among them."""
        kept = list(here & self.slots.keys())
        at = np.array([self.slots[w] for w in kept], np.int64)
        counts, flat = self.counts[0], self.flat[0]
        begins = np.cumsum(counts) - counts
        self.slots = Slots(zip(kept, range(len(kept))))
        self.flat, self.counts = [flat[ranges(begins[at], counts[at])]], [counts[at]]

    def pieces(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces one after another, and how many each has."""
        lengths = np.array([len(piece) for piece in found])
        ends = np.cumsum(lengths)
        whole = np.frombuffer(b"".join(found), np.uint8)
        rows = {
            "piece": np.repeat(np.arange(len(found), dtype=np.int32), lengths),
            "pos": (np.arange(len(whole)) - np.repeat(ends - lengths, lengths)).astype(np.int32),
            "id": self.bytes[whole],
            "len": np.ones(len(whole), np.int32),
        }
        self.db.register("start", pa.table(rows))
        merged = self.db.execute(_MERGE).fetchnumpy()
        self.db.unregister("start")
        return np.asarray(merged["id"], np.int32), np.bincount(merged["piece"], minlength=len(found))

    def learn(self, new: list[str]) -> None:
        """Encode pieces not seen before, in the order of their slots."""
        raw = [piece.encode() for piece in new]
        ranks = [self.ranks.get(b) for b in raw]
        whole = [i for i, rank in enumerate(ranks) if rank is not None]
        queried = [i for i, rank in enumerate(ranks) if rank is None and len(raw[i]) <= QUERY_BYTES]
        order, flat, counts = [whole], [np.array([ranks[i] for i in whole], np.int32)], [np.ones(len(whole), np.int64)]
        lengths = np.array([len(raw[i]) for i in queried], np.int64)
        query = np.cumsum(lengths * (lengths + 1) // 2) // QUERY_ROWS
        for some in np.split(np.array(queried, np.int64), np.flatnonzero(np.diff(query)) + 1):
            if not len(some):
                continue
            ids, each = self.pieces([raw[i] for i in some])
            order.append(some), flat.append(ids), counts.append(each)
        for i, rank in enumerate(ranks):
            if rank is None and len(raw[i]) > QUERY_BYTES:
                ids = self.contract(raw[i])
                order.append([i]), flat.append(ids), counts.append(np.array([len(ids)]))
        at = np.argsort(np.concatenate([np.array(o, np.int64) for o in order]))
        each = np.concatenate(counts)
        begins = np.cumsum(each) - each
        self.flat.append(np.concatenate(flat)[ranges(begins[at], each[at])])
        self.counts.append(each[at])

    def contract(self, piece: bytes) -> np.ndarray:
        """The same contraction with a heap of pairs by rank, then position."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (rank := self.pairs.get((ids[i], ids[after[i]]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], after[i], ids[after[i]]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, left, j, right = heapq.heappop(heap)
            if ids[i] != left or after[i] != j or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end."""
        words = [self.find(t) for t in texts]
        if len(self.slots) > REMEMBERED:
            self._forget(set(itertools.chain.from_iterable(words)))
        known = len(self.slots)
        each_word = map(self.slots.__getitem__, itertools.chain.from_iterable(words))
        at = np.fromiter(each_word, np.int64, sum(map(len, words)))
        self.learn(list(itertools.islice(self.slots, known, None)))
        self.flat, self.counts = [np.concatenate(self.flat)], [np.concatenate(self.counts)]
        flat, counts = self.flat[0], self.counts[0]
        begins = np.cumsum(counts) - counts
        each = counts[at]
        ids = flat[ranges(begins[at], each)]
        borders = np.concatenate([[0], np.cumsum(each)])[np.cumsum([len(row) for row in words])]
        return ids, borders

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> list[bytes]:
        """The bytes of each of the texts whose ids end at the borders."""
        lengths = np.diff(borders, prepend=0)
        doc = np.repeat(np.arange(len(borders), dtype=np.int32), lengths)
        out: list[list[bytes]] = [[] for _ in borders]
        for a in range(0, len(ids), QUERY_IDS):
            some = ids[a : a + QUERY_IDS]
            rows = {"doc": doc[a : a + QUERY_IDS], "pos": np.arange(len(some), dtype=np.int32), "id": some}
            self.db.register("ids", pa.table(rows))
            for n, hex in self.db.execute(_DECODE).fetchall():
                out[n].append(bytes.fromhex(hex))
            self.db.unregister("ids")
        return [b"".join(parts) for parts in out]


@functools.lru_cache(maxsize=1)
def codec_of(path: str, pattern: str) -> Codec:
    """The codec of a Python worker, which serves one task after another."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = True) -> DataFrame:
    """The documents' columns and ``bpe``: the text's ids and, unless told otherwise, the
    bytes decoded from these ids."""

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(path, pattern)
        for column in batches:
            texts = [t or "" for t in column.to_pylist()]
            all_ids, offsets, back = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], []
            for a, b in chunks(texts, RUN_BYTES):
                ids, borders = codec.encode(texts[a:b])
                offsets.append(borders + offsets[-1][-1])
                all_ids.append(ids)
                back += codec.decode(ids, borders) if decoded else [None] * (b - a)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(all_ids)))
            yield pa.StructArray.from_arrays([lists, pa.array(back, pa.binary())], ["ids", "decoded"])

    return docs.withColumn("bpe", run(F.col(text)))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows' columns and ``decoded``, the bytes of their ids. Null ids give no bytes."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(path, pattern)
        for column in batches:
            lists = [np.array(x or [], np.int32) for x in column.to_pylist()]
            back = []
            for a, b in chunks(lists, 1 << 18):
                borders = np.cumsum([len(x) for x in lists[a:b]])
                back += codec.decode(np.concatenate(lists[a:b]), borders)
            yield pa.array(back, pa.binary())

    return rows.withColumn("decoded", run(F.col(ids)))
