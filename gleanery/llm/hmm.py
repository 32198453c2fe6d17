"""Hidden Markov language model of words.

Words are counted over all training texts. The most frequent ones are symbols of their own
(``OWN`` at most), all others share symbols by their last letters; a hidden state emits a
symbol, and a shared symbol a word by its smoothed share of the symbol's count, whatever
the state. So the model's tables have a fixed size, while every word counts.

Baum-Welch runs over all training texts, cut into spans of ``SPAN`` tokens: each task adds
up expected transitions and emissions with scaled forward and backward recursions, and the
sums of all tasks are the next model. A text's likelihood is exact: one scaled forward
recursion over all its tokens.

Counts of frequent words (``HEAD`` at most) are broadcast; the other words of each text
meet their counts in a join. A null or empty text is the end token alone. Where nothing is
learned from, all counts are zero and the model is uniform. Repeated rows are scored, and
learned from, one by one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanery.llm.texts import chunks, raw
from gleanery.session import scratch_path, shared_dir

STATES = 8
OWN = 4096
SHARED = 256
HEAD = 200_000
SPAN = 256
TOGETHER = 512  # spans worked on at once
ROUNDS = 4
PRIOR = 50.0  # tokens' worth of the corpus' own frequencies in each state
FLUSH = 400_000  # words counted in a task before they are handed on

END = 0  # the end token's symbol; symbols 1 to SHARED are shared, own ones follow


def tokens(text: bytes) -> list[bytes]:
    """The words; the end token follows them unseen."""
    return text.lower().split()


def shared_symbol(word: bytes) -> int:
    return 1 + zlib.crc32(word[-3:]) % SHARED


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def handed_on(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts):
            for text in texts[a:b]:
                counts.update(tokens(text))
            if len(counts) >= FLUSH:
                yield handed_on(counts)
                counts = Counter()
    yield handed_on(counts)


@dataclass
class Vocabulary:
    """Counts of the frequent words, and totals of the shared symbols; of bounded size."""

    head: dict[bytes, tuple[int, int]]  # symbol and count
    own: list[bytes]
    ends: int
    n: int
    v: int
    shared_totals: np.ndarray  # [symbol]: count and words of each shared one, for its words' shares
    frequency: np.ndarray = field(default=None)

    @property
    def symbols(self) -> int:
        return 1 + SHARED + len(self.own)


def count_words(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """(word, n) over all given documents, and the number of these."""
    shared_dir(docs.sparkSession)
    counts = docs.select(raw(text).alias("text")).mapInArrow(_count, "word binary, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).checkpoint(), docs.count()


def vocabulary(counts: DataFrame, ends: int, own: int = OWN, head: int = HEAD) -> Vocabulary:
    # counts of counts, in steps of an eighth of a power of two: a threshold, not a sort
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()

    def least(limit: int) -> int:
        total, found = 0, 1 << 20
        for at, words in sizes:
            total += words
            if total > limit:
                break
            found = at
        return found

    rows = counts.where(step >= least(head)).select("word", "n", (step >= least(own)).alias("own")).collect()
    ownwords = sorted(bytes(r["word"]) for r in rows if r["own"])
    symbol = {w: 1 + SHARED + i for i, w in enumerate(ownwords)}
    known = {bytes(r["word"]): (symbol.get(bytes(r["word"])) or shared_symbol(bytes(r["word"])), r["n"]) for r in rows}
    place = 1 + F.crc32(F.substring("word", -3, 3)) % SHARED
    totals = np.zeros((2, 1 + SHARED))
    for at, n, v in counts.where(step < least(own)).groupBy(place.cast("int")).agg(F.sum("n"), F.count("*")).collect():
        totals[:, at] = n, v
    n, v = counts.agg(F.sum("n"), F.count("*")).first()
    out = Vocabulary(known, ownwords, ends, (n or 0) + ends, v + (ends > 0), totals)
    out.frequency = np.concatenate([[ends], totals[0, 1:], [known[w][1] for w in ownwords]]) + 0.5
    out.frequency /= out.frequency.sum()
    return out


def _encoder(shared):
    kind = pa.struct(
        [(c, pa.int64()) for c in ("n_tokens", "n_known")]
        + [(c, pa.float64()) for c in ("counts", "within")]
        + [("symbols", pa.binary()), ("rare", pa.list_(pa.binary()))]
    )

    @F.arrow_udf("struct<n_tokens:bigint,n_known:bigint,counts:double,within:double,symbols:binary,rare:array<binary>>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words: Vocabulary = shared.value
        get, first = words.head.get, 1 + SHARED
        shares = -np.log10(words.shared_totals.sum(axis=0) + 1)
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                found = tokens(text)
                rare = [w for w in found if w not in words.head]
                pairs = [get(w) or (shared_symbol(w), 0) for w in found]
                both = np.array(pairs, np.int64).reshape(-1, 2)
                symbols, seen = both[:, 0], np.log10(both[:, 1] + 1.0)
                inside = symbols < first
                rows.append(
                    {
                        "n_tokens": len(found) + 1,
                        "n_known": len(found) - len(rare) + (words.ends > 0),
                        "counts": float(seen.sum() + np.log10(words.ends + 1)),
                        "within": float(seen[inside].sum() + shares[symbols[inside]].sum()),
                        "symbols": np.append(symbols, END).astype(np.uint16).tobytes(),
                        "rare": rare,
                    }
                )
            yield pa.array(rows, kind)

    return encode


@dataclass
class Model:
    start: np.ndarray  # [state]
    moves: np.ndarray  # [state, next state]
    emit: np.ndarray  # [symbol, state]


def first_model(words: Vocabulary) -> Model:
    """The corpus' frequencies in every state, bent by the words' last letters, so that
    states start out different and alike words together."""
    ends = [b""] + [bytes([i]) for i in range(SHARED)] + [w[-2:] for w in words.own]
    bend = np.array([[zlib.crc32(e + bytes([s])) / 2**32 for s in range(STATES)] for e in ends])
    emit = words.frequency[:, None] * (0.25 + bend)
    moves = np.full((STATES, STATES), 0.1 / (STATES - 1))
    np.fill_diagonal(moves, 0.9)
    return Model(np.full(STATES, 1 / STATES), moves, emit / emit.sum(axis=0))


def stationary(moves: np.ndarray) -> np.ndarray:
    return np.linalg.matrix_power(moves, 256)[0]


def expected(model: Model, spans: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions over spans of symbols [time, span]; beyond a
    span's end stands the number of symbols. ``firsts``: spans at the start of a text."""
    n_symbols = len(model.emit)
    emit = np.vstack([model.emit, np.ones(STATES)])[spans]
    length, many = spans.shape
    alpha, scale = np.empty((length, many, STATES)), np.empty((length, many, 1))
    now = np.where(firsts[:, None], model.start, stationary(model.moves)) * emit[0]
    for t in range(length):
        if t:
            now = (alpha[t - 1] @ model.moves) * emit[t]
        scale[t] = now.sum(axis=1, keepdims=True)
        alpha[t] = now / scale[t]
    moves, beta = np.zeros((STATES, STATES)), np.ones((many, STATES))
    for t in range(length - 1, -1, -1):
        if t + 1 < length:
            ahead = emit[t + 1] * beta / scale[t + 1]
            real = (spans[t + 1] < n_symbols)[:, None]
            moves += alpha[t].T @ (ahead * real)
            beta = ahead @ model.moves.T
        alpha[t] *= beta  # from here on the states' probabilities
    flat, states = spans.ravel(), alpha.reshape(-1, STATES)
    emissions = np.stack([np.bincount(flat, states[:, s], n_symbols + 1)[:n_symbols] for s in range(STATES)], axis=1)
    return alpha[0][firsts].sum(axis=0), moves * model.moves, emissions


def spans_of(texts: list[np.ndarray], filler: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' symbols in spans of about one length [time, span], and which begin a text."""
    cut = [(x[i : i + SPAN], i == 0) for x in texts for i in range(0, len(x), SPAN)]
    cut.sort(key=lambda c: len(c[0]))
    for a in range(0, len(cut), TOGETHER):
        some = cut[a : a + TOGETHER]
        out = np.full((len(some[-1][0]), len(some)), filler, np.int64)
        for i, (x, _) in enumerate(some):
            out[: len(x), i] = x
        yield out, np.array([first for _, first in some])


def _expecter(shared):
    names = ["place", *[f"s{i}" for i in range(STATES)]]

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        n = len(model.emit)
        sums = np.zeros((1 + STATES + n, STATES))  # starts, moves, emissions
        for batch in batches:
            texts = [np.frombuffer(x, np.uint16) for x in batch.column(0).to_pylist()]
            for spans, firsts in spans_of(texts, n):
                starts, moves, emissions = expected(model, spans, firsts)
                sums[0] += starts
                sums[1 : 1 + STATES] += moves
                sums[1 + STATES :] += emissions
        some = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(sums[some, i]) for i in range(STATES)]], names)

    return expect, "place bigint, " + ", ".join(f"{x} double" for x in names[1:])


def train(symbols: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over a column of encoded texts."""
    model, spark = first_model(words), symbols.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        run, schema = _expecter(shared)
        parts = symbols.mapInArrow(run, schema)
        rows = parts.groupBy("place").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(STATES)]).toArrow()
        shared.destroy()
        sums = np.zeros((1 + STATES + len(model.emit), STATES))
        sums[rows["place"].to_numpy()] = np.stack([rows[f"s{i}"].to_numpy() for i in range(STATES)], axis=1)
        starts, moves, emit = sums[0] + 1, sums[1 : 1 + STATES] + 0.1, sums[1 + STATES :]
        emit = emit + PRIOR * words.frequency[:, None]
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def log10_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Of each text's symbols: a scaled forward recursion over all texts at once, from
    which the shorter ones drop out as they end."""
    order = np.argsort([-len(x) for x in texts], kind="stable")
    lengths = np.array([len(texts[i]) for i in order])
    flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    out = np.zeros(len(texts))
    state = np.tile(model.start, (len(texts), 1))
    for t in range(lengths[0]):
        if t:
            alive = np.searchsorted(-lengths, -t, side="left")  # those longer than t
            state = state[:alive] @ model.moves
        state = state * model.emit[flat[begins[: len(state)] + t]]
        scale = state.sum(axis=1)
        out[: len(state)] += np.log10(scale)
        state /= scale[:, None]
    back = np.empty(len(texts))
    back[order] = out
    return back


def _scorer(shared):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts = [np.frombuffer(x, np.uint16) for x in column.to_pylist()]
            yield pa.array(log10_likelihood(shared.value, texts) if texts else np.empty(0))

    return score


def score_texts(docs: DataFrame, learn, id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, learned_from, n_tokens, n_known, train_tokens, base_score, score) of every
    document, learning from those for which the condition ``learn`` holds."""
    spark = docs.sparkSession
    counts, ends = count_words(docs.where(learn), text)
    words = vocabulary(counts, ends)
    shared = spark.sparkContext.broadcast(words)
    encoded = docs.select(F.col(id).alias("_id"), learn.alias("learned_from"), _encoder(shared)(raw(text)).alias("e"))
    path = scratch_path(spark, "encoded")
    encoded.select(F.monotonically_increasing_id().alias("row"), "_id", "learned_from", "e.*").write.parquet(path)
    encoded = spark.read.parquet(path)
    model = spark.sparkContext.broadcast(train(encoded.where("learned_from").select("symbols"), words, rounds))
    rare = encoded.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rare"), F.count("n").alias("rare_known"))
    scored = encoded.select("row", "_id", "learned_from", "n_tokens", "n_known", "counts", "within", _scorer(model)("symbols").alias("path"))
    more = F.coalesce("rare", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        F.col("_id").alias(id),
        "learned_from",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.n).cast("bigint").alias("train_tokens"),
        (F.col("counts") + more - F.col("n_tokens") * float(np.log10(words.n + words.v + 1))).alias("base_score"),
        (F.col("path") + F.col("within") + more).alias("score"),
    )
