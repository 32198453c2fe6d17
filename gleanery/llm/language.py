"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, which a forward algorithm
adds up; a text's is the product over its words and the language's share. The pieces'
probabilities are learned by expectation maximisation over the words counted in labelled
texts: a backward pass gives how often each piece is expected in each word. Both passes
rescale at every letter, so that no run of rare letters is lost to underflow.

Words are runs of letters in lower case, marked at their start, and are never cut: of a run
beyond ``SPAN`` letters only a span is held at once, and both passes carry their sums from
span to span. A character that no piece covers is one unknown piece. A text without letters, or null, is ``und`` with score 0, and so is every text where
nothing was labelled. Equal scores go to the first language by name. Repeated rows are
judged one by one. A very long text costs work by its length, in one task.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from gleanery.llm.texts import chunks
from gleanery.session import shared_dir

SPAN = 4096  # letters of a word worked on at once
LONGEST = 16  # letters in a piece
ROUNDS = 2
SMOOTHING = 0.1
UNDETERMINED = "und"
FLUSH = 400_000  # words counted in a task before they are handed on
REMEMBERED = 500_000  # words whose scores a Python worker keeps
START = "▁"

_LETTERS = regex.compile(r"\p{L}+")


def words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


class Lattice:
    """All segmentations of words into the pieces of a vocabulary."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        usable = [p for i, p in enumerate(pieces) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(len(p) > LONGEST and _LETTERS.fullmatch(p.removeprefix(START)) for p in usable):
            raise ValueError(f"the vocabulary has pieces of over {LONGEST} letters")
        self.ids = {p: i + 1 for i, p in enumerate(dict.fromkeys(p for p in usable if len(p) <= LONGEST))}
        self.size = len(self.ids) + 2  # 0 is the unknown piece, the last one no piece
        self.none = self.size - 1
        # the pieces' beginnings as a tree: a node and a letter give the next node
        nodes = {"": 0}
        for p in self.ids:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        letters = sorted({p[-1] for p in nodes if p})
        self.letter = np.zeros(0x110000, np.uint16)  # 0 stands in no piece
        self.letter[list(map(ord, letters))] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        steps = {nodes[p[:-1]] * self.letters + int(self.letter[ord(p[-1])]): i for p, i in nodes.items() if p}
        self.steps = np.array(sorted(steps), np.int64)
        self.next = np.array([steps[x] for x in self.steps.tolist()], np.int64)
        self.piece = np.array([self.ids.get(p, self.none) for p in nodes], np.int32)

    def arcs(self, some: list[str]) -> np.ndarray:
        """Piece ids [word, start, length - 1] in marked words of one length."""
        n = len(some[0])
        reach = min(LONGEST, n)
        letter = self.letter[np.frombuffer("".join(some).encode("utf-32-le"), np.uint32)]
        out = np.full((len(some) * n, reach), self.none, np.int32)
        place = np.arange(len(letter))
        left = n - place % n  # letters to the word's end
        node = np.zeros(len(letter), np.int64)
        for k in range(reach):
            here = left[place] > k
            place, node = place[here], node[here]
            step = node * self.letters + letter[place + k]
            at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            here = self.steps[at] == step
            place, node = place[here], self.next[at[here]]
            out[place, k] = self.piece[node]
        out[:, 0][out[:, 0] == self.none] = 0
        return out.reshape(len(some), n, reach)

    def by_length(self, some: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, arcs) of words of equal length up to ``SPAN``, a bounded number at a time."""
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        for n in np.unique(lengths[lengths <= SPAN]):
            places = np.flatnonzero(lengths == n)
            step = max(1, 200_000 // ((int(n) + 1) * min(LONGEST, int(n) + 1)))
            for a in range(0, len(places), step):
                yield places[a : a + step], self.arcs([START + some[i] for i in places[a : a + step]])

    def span(self, word: str, start: int) -> tuple[int, np.ndarray]:
        """(low, arcs) of a marked word's next ``SPAN`` letters, and of those before them that
        an arc into the span may start at, from ``low`` on."""
        low = max(0, start - LONGEST + 1)
        return low, self.arcs([word[low : start + SPAN]])


@functools.lru_cache(maxsize=1)
def lattice_of(path: str) -> Lattice:
    """The lattice of a Python worker, which serves one task after another."""
    return Lattice(path)


def forward(arcs: np.ndarray, chances: np.ndarray, place: np.ndarray | None = None, done: int = 0, before: np.ndarray | None = None):
    """Logarithms of the sums over all segmentations [word, language]; where ``place`` picks
    one language for each word, each end's shares [word, length - 1], how much of the sum up
    to this end comes by the arc of that length; and the sums up to the last starts. A sum is
    kept relative to the one before it, so none is too small for a number however rare the
    letters. ``done`` letters are those of an earlier span, which gave ``before``."""
    n, reach = arcs.shape[1:]
    logs = np.zeros((len(arcs), chances.shape[1] if place is None else 1))
    first = np.ones((len(arcs), 1, logs.shape[1]))
    before = first if before is None else before  # sums up to the last starts, by that of the last one
    shares = []
    for end in range(done + 1, n + 1):
        k = np.arange(1, min(reach, end) + 1)
        some = arcs[:, end - k, k - 1]
        parts = before * (chances[some] if place is None else chances[some, place[:, None]][..., None])
        step = parts.sum(axis=1, keepdims=True)
        logs += np.log(step[:, 0])
        if place is not None:
            shares.append((parts / step)[..., 0])
        before = np.concatenate([first, before[:, : reach - 1] / step], axis=1)
    return logs, shares, before


def backward(shares: list[np.ndarray], back: np.ndarray, shape: tuple[int, int, int], done: int = 0) -> np.ndarray:
    """How often each arc [word, start, length - 1] is expected. ``back`` has how often a
    segmentation has a border at a letter, what its arcs from there on have; it is added to."""
    got = np.zeros(shape)
    for end in range(shape[1], done, -1):
        k = np.arange(1, min(shape[2], end) + 1)
        part = shares[end - done - 1] * back[:, end, None]
        got[:, end - k, k - 1] = part
        back[:, end - k] += part
    return got


def log_chances(lattice: Lattice, chances: np.ndarray, some: list[str]) -> np.ndarray:
    """Log-probability [word, language] summed over all segmentations."""
    out = np.zeros((len(some), chances.shape[1]))
    for places, arcs in lattice.by_length(some):
        out[places] = forward(arcs, chances)[0]
    for i, word in enumerate(some):
        before, marked = None, START + word if len(word) > SPAN else ""
        for start in range(0, len(marked), SPAN):
            low, arcs = lattice.span(marked, start)
            logs, _, before = forward(arcs, chances, None, start - low, before)
            out[i] += logs[0]
    return out


def expected(lattice: Lattice, chances: np.ndarray, some: list[str], place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected counts [piece, language] of words seen ``weight`` times in one language each."""
    out = np.zeros(chances.shape)

    def add(arcs: np.ndarray, got: np.ndarray, langs: np.ndarray) -> None:
        cells = arcs.astype(np.int64) * chances.shape[1] + langs[:, None, None]
        out.ravel()[:] += np.bincount(cells.ravel(), got.ravel(), out.size)

    for places, arcs in lattice.by_length(some):
        _, shares, _ = forward(arcs, chances, place[places])
        back = np.zeros((len(arcs), arcs.shape[1] + 1))
        back[:, -1] = weight[places]
        add(arcs, backward(shares, back, arcs.shape), place[places])
    for i in np.flatnonzero(np.fromiter(map(len, some), np.int64, len(some)) > SPAN):
        # the sums at each span's start are kept, its shares made anew on the way back
        marked, lang, carried = START + some[i], place[i : i + 1], [None]
        starts = range(0, len(marked), SPAN)
        for start in starts:
            low, arcs = lattice.span(marked, start)
            carried.append(forward(arcs, chances, lang, start - low, carried[-1])[2])
        back = np.zeros((1, len(marked) + 1))
        back[:, -1] = weight[i]
        for start, before in zip(reversed(starts), carried[-2::-1]):
            low, arcs = lattice.span(marked, start)
            _, shares, _ = forward(arcs, chances, lang, start - low, before)
            add(arcs, backward(shares, back[:, low : low + arcs.shape[1] + 1], arcs.shape, start - low), lang)
    out[-1] = 0
    return out


def _counter(places: dict[str, int]):
    def handed_on(counts: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
        for place, some in counts.items():
            columns = [pa.array(some, pa.string()), pa.array([place] * len(some), pa.int32()), pa.array(some.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "lang", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}
        held = 0
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = counts.setdefault(places[lang], Counter())
                held -= len(own)
                own.update(words(text))
                held += len(own)
                if held >= FLUSH:
                    yield from handed_on(counts)
                    counts, held = {}, 0
        yield from handed_on(counts)

    return count


def _expecter(path: str, shared):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, chances = lattice_of(path), shared.value
        totals = np.zeros(chances.shape)
        for batch in batches:
            some, place, weight = (batch.column(i) for i in range(3))
            totals += expected(lattice, chances, some.to_pylist(), place.to_numpy(), weight.to_numpy())
        piece, lang = np.nonzero(totals)
        columns = [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(totals[piece, lang])]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "lang", "n"])

    return expect


class Model:
    def __init__(self, langs: list[str], shares: np.ndarray, chances: np.ndarray):
        self.langs, self.shares, self.chances = langs, shares, chances


def train(docs: DataFrame, path: str, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all given documents whose language is known."""
    spark = docs.sparkSession
    shared_dir(spark)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    found = known.groupBy(lang).count().orderBy(lang).collect()
    langs = [r[0] for r in found]
    lattice = Lattice(path)
    chances = np.full((lattice.size, max(len(langs), 1)), 1 / lattice.size)
    chances[-1] = 0
    shares = np.log(np.array([r[1] for r in found], float) / max(sum(r[1] for r in found), 1))
    if not langs:
        return Model(langs, shares, chances)
    counted = known.mapInArrow(_counter({x: i for i, x in enumerate(langs)}), "word string, lang int, n bigint")
    counted = counted.groupBy("word", "lang").agg(F.sum("n").alias("n")).checkpoint()
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(chances)
        parts = counted.mapInArrow(_expecter(path, shared), "piece int, lang int, n double")
        rows = parts.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()  # at most pieces x languages
        counts = np.full(chances.shape, SMOOTHING)
        counts[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
        counts[-1] = 0
        chances = counts / counts.sum(axis=0)
        shared.destroy()
    return Model(langs, shares, chances)


class Scorer:
    """Scores the texts of a Python worker's tasks; scores of words are kept. When they
    are too many, those of the texts at hand stay, the frequent ones among them."""

    def __init__(self, path: str, model: Model):
        self.model, self.lattice = model, lattice_of(path)
        self.slots: dict[str, int] = {}
        self.scores = np.empty((0, len(model.langs)))

    def judge(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        if not self.model.langs:
            yield from ((UNDETERMINED, 0.0) for _ in texts)
            return
        found = [words(t) for t in texts]
        here = set(itertools.chain.from_iterable(found))
        if len(self.slots) > REMEMBERED:
            kept = list(here & self.slots.keys())
            self.scores = self.scores[[self.slots[w] for w in kept]]
            self.slots = dict(zip(kept, range(len(kept))))
        new = list(here - self.slots.keys())
        if new:
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
            self.scores = np.concatenate([self.scores, log_chances(self.lattice, self.model.chances, new)])
        for row in found:
            if not row:
                yield UNDETERMINED, 0.0
                continue
            total = self.model.shares + self.scores[np.fromiter(map(self.slots.__getitem__, row), np.int64, len(row))].sum(axis=0)
            best = int(total.argmax())
            yield self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


@functools.lru_cache(maxsize=1)
def scorer_of(path: str, model: Model) -> Scorer:
    """The scorer of a Python worker, which serves one task after another."""
    return Scorer(path, model)


def identify(docs: DataFrame, model: Model, path: str, text: str = "text") -> DataFrame:
    """The documents' columns and ``language``: lang_pred, and score, its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = scorer_of(path, shared.value)
        for column in batches:
            texts = [t or "" for t in column.to_pylist()]
            rows = [r for a, b in chunks(texts) for r in scorer.judge(texts[a:b])]
            yield pa.array([{"lang_pred": x, "score": s} for x, s in rows], kind)

    return docs.withColumn("language", judge(F.col(text)))
