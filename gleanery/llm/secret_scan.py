"""Secret scans: fixed patterns, and character Markov models of random strings.

The patterns find assigned credentials, access keys and long hex strings. What they find
labels the samples: values found are strings that somebody drew at random, every other run
of identifier characters in the corpus is ordinary. The transitions between characters are
counted in both, over all documents, and give two first-order Markov models. A further run
of ``MIN_LENGTH`` characters or more is a secret if the logarithm of its likelihood ratio
is beyond ``EVIDENCE`` in all and ``PER_CHAR`` for each character; so is a part as long
that the patterns' spans leave of a run.

Spans are counted in code points, ends exclusive. Null or empty texts have none; where the
corpus has no samples, both models are uniform and only the patterns find anything.
Repeated rows are scanned, and counted, one by one. A very long text is scanned whole, in one
task. Without rows nothing is returned.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gleanery.llm.texts import chunks, unused

# fixed values: the base patterns, and their least lengths
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_LENGTH = 8

MIN_LENGTH = 16
EVIDENCE = 25.0
PER_CHAR = 0.8

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODES = np.zeros(256, np.int64)  # 0 stands for everything between identifiers
_CODES[list(_ALPHABET)] = np.arange(1, len(_ALPHABET) + 1)
SYMBOLS = len(_ALPHABET) + 1

SPANS = "array<struct<kind:string,start:int,end:int>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, place in KINDS, random part) of what the patterns find, sorted."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LENGTH:
                found.append((m.start(), m.end(), 0, m[2]))
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def _transitions(text: bytes) -> np.ndarray:
    codes = _CODES[np.frombuffer(b" " + text + b" ", np.uint8)]
    return np.bincount(codes[:-1] * SYMBOLS + codes[1:], minlength=SYMBOLS * SYMBOLS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transitions in random (1) and ordinary (0) strings, one set of rows for a task."""
    totals = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts):
            random, rest = [], []
            for text in texts[a:b]:
                at = 0
                for start, end, _, value in base_spans(text):
                    random.append(value)
                    rest.append(text[at:start])
                    at = max(at, end)
                rest.append(text[at:])
            totals[0] += _transitions(" ".join(rest).encode())
            totals[1] += _transitions(" ".join(random).encode())
    kind, at = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(totals[kind, at], pa.int64())], ["kind", "at", "n"]
    )


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio, random to ordinary, of each transition. Its size is fixed."""
    texts = docs.where(F.col(text).isNotNull()).select(text)
    rows = texts.mapInArrow(_count, "kind int, at int, n bigint").groupBy("kind", "at").agg(F.sum("n")).collect()
    counts = np.ones((2, SYMBOLS, SYMBOLS))
    for kind, at, n in rows:
        counts[kind, at // SYMBOLS, at % SYMBOLS] += n
    chances = np.log(counts / counts.sum(axis=2, keepdims=True))
    return chances[1] - chances[0]


def _beside(text: str, base: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int]]:
    """What the sorted base spans leave of each run, in parts of MIN_LENGTH or more."""
    first = 0  # base span that may reach behind the run's start
    far = list(itertools.accumulate((s[1] for s in base), max))
    for m in _RUN.finditer(text):
        at, stop = m.span()
        while first < len(base) and far[first] <= at:
            first += 1
        i = first
        while i < len(base) and base[i][0] < stop:
            if base[i][0] - at >= MIN_LENGTH:
                yield at, base[i][0]
            at = max(at, base[i][1])
            i += 1
        if stop - at >= MIN_LENGTH:
            yield at, stop


def all_spans(text: str, ratios: np.ndarray) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    found = [(start, end, kind) for start, end, kind, _ in base]
    for start, end in _beside(text, base):
        codes = _CODES[np.frombuffer(text[start:end].encode(), np.uint8)]
        ratio = ratios[0, codes[0]] + ratios[codes[:-1], codes[1:]].sum() + ratios[codes[-1], 0]
        if ratio >= max(EVIDENCE, PER_CHAR * len(codes)):
            found.append((start, end, 3))
    return [(start, end, KINDS[kind]) for start, end, kind in sorted(found, key=lambda s: (s[0], s[2]))]


def secret_spans(docs: DataFrame, text: str = "text", ratios: np.ndarray | None = None) -> DataFrame:
    """The documents' columns and ``secrets``: kind, start and end of each secret, by start,
    then kind in the order of ``KINDS``."""
    ratios = train(docs, text) if ratios is None else ratios
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = (all_spans(t or "", ratios) for t in texts.to_pylist())
            yield pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in row] for row in rows], span)

    return docs.withColumn("secrets", scan(F.col(text)))


def masked(text: str, ratios: np.ndarray, mask: str) -> str:
    out, at = [], 0
    for start, end, _ in all_spans(text, ratios):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]", ratios: np.ndarray | None = None) -> DataFrame:
    """The documents with each secret (overlapping ones together) replaced by the mask. A
    column ``n_chars`` follows the text where that changed. A null text stays null."""
    ratios = train(docs, text) if ratios is None else ratios

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([None if t is None else masked(t, ratios, mask) for t in texts.to_pylist()], pa.string())

    name = unused(docs, "clean")
    found = docs.withColumn(name, clean(F.col(text)))
    if "n_chars" in docs.columns:
        changed = ~F.col(name).eqNullSafe(F.col(text))
        length = F.length(name).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return found.withColumn(text, F.col(name)).drop(name)


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
