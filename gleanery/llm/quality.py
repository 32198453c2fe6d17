"""Quality classifier: random Fourier features over document statistics.

Statistics of a text (lengths, kinds of characters, repetition) are standardised and mapped
to ``FEATURES`` random cosines, whose inner products approximate a Gaussian kernel. The sums
of the normal equations are added up over the partitions and solved once for ridge scores.
One fold of the labelled rows is kept apart to calibrate them: scores in narrow bins, made
monotone by pooling neighbours. Only matrices of fixed size reach the driver.

A null text counts as an empty one and gets a score as any other. Documents without an id
are scored and not learned from; several labels of one id count as their mean. Without
labels every score is 0.5. Repeated rows are scored one by one, equal ones alike. Of a text of
any length only its statistics are kept. Without documents nothing is returned. Where the fold
kept apart has no labelled row, the rows that were learned from calibrate the scores too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleanery.llm.texts import fold, raw
from gleanery.session import shared_dir

FEATURES = 256
RIDGE = 1e-5  # for each row learned from
SEED = 20
FOLDS, CALIBRATION = 5, 1  # fold 0 is held out
LOW, HIGH, STEP = -0.5, 1.5, 1 / 400  # bins of uncalibrated scores

_CLASSES = np.zeros((9, 256))
for _row, _bytes in enumerate(
    (
        range(0x41, 0x5B),
        range(0x61, 0x7B),
        range(0x30, 0x3A),
        (0x20, *range(0x09, 0x0E)),
        b".,;:?'\"-()",
        b"#*$%&|<>",
        b"!",
        b"|",
        range(0x80, 0x100),
    )
):
    _CLASSES[_row, list(_bytes)] = 1
N_STATS = 20


def statistics(text: bytes) -> list[float]:
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(len(text), 1)
    upper, lower, digit, space, stops, symbols, cries, bars, other = (_CLASSES @ histogram).tolist()
    words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
    distinct = len(set(words))
    count = max(len(words), 1)
    shares = histogram[histogram > 0] / n
    return [
        np.log1p(len(words)),
        np.log1p(len(text)),
        (n - space) / count,
        upper / max(upper + lower, 1),
        digit / n,
        space / n,
        stops / n,
        symbols / n,
        cries / n,
        bars / n,
        other / n,
        float(-(shares * np.log(shares)).sum()),
        distinct / count,
        np.log1p(count / max(distinct, 1)),
        len(set(zip(words, words[1:]))) / count,
        np.log1p(len(lines)),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(words) / max(len(lines), 1)),
        sum(line.rstrip().endswith((b".", b"?", b"!", b":")) for line in lines) / max(len(lines), 1),
        (upper + lower + other) / n,
    ]


def _stats_udf():
    @F.arrow_udf("array<double>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return stats


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents' columns and ``stats``."""
    return docs.withColumn("stats", _stats_udf()(raw(text)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), N_STATS)


class Model:
    """Random features, ridge weights and calibration; of fixed size."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        random = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.directions = random.normal(0, np.sqrt(2 / N_STATS), (N_STATS, FEATURES))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.bins = self.levels = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([np.ones((len(z), 1)), cosines])

    def ridge_scores(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.bins is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.ridge_scores(stats), self.bins, self.levels), 0, 1)

    def calibrate(self, bins: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> None:
        """Isotonic regression: neighbours out of order are pooled."""
        pools: list[list[float]] = []
        for one, n in zip(ones, counts):
            pools.append([one, n, 1])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last)]
        self.bins = LOW + (bins + 0.5) * STEP
        self.levels = np.repeat([one / n for one, n, _ in pools], [size for _, _, size in pools])


def _normal_equations(model: Model):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FEATURES + 2, FEATURES + 2))
        for batch in batches:
            rows = np.hstack([model.features(_matrix(batch.column(0))), batch.column(1).to_numpy()[:, None]])
            sums += rows.T @ rows
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums.tolist())], ["i", "sums"])

    return add_up


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """``stats``: doc_id, fold, stats; fold 0 is not looked at. ``labels``: doc_id, quality."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("mark"))
    known = stats.where("fold != 0").join(marks, "doc_id").select("fold", "stats", "mark").checkpoint()
    moments = [f(F.get("stats", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(N_STATS)]
    row = known.agg(F.count("*"), *moments).first()
    if not row[0]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    scale = np.array(row[1 + N_STATS :])
    model = Model(np.array(row[1 : 1 + N_STATS]), np.where(scale > 1e-9, scale, 1))
    learned = known.where(F.col("fold") != CALIBRATION).select("stats", "mark")
    parts = learned.mapInArrow(_normal_equations(model), "i int, sums array<double>")
    cells = parts.select("i", F.posexplode("sums").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    sums = np.zeros((FEATURES + 2, FEATURES + 2))
    for i, j, x in cells.collect():
        sums[i, j] = x
    gram, target, n = sums[:-1, :-1], sums[:-1, -1], sums[0, 0]
    penalty = np.eye(FEATURES + 1) * max(RIDGE * n, 1e-9)
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, target)

    @F.arrow_udf("double")
    def ridge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(model.ridge_scores(_matrix(column)))

    apart = known.where(F.col("fold") == CALIBRATION)
    chosen = apart if not apart.isEmpty() else known
    place = F.floor((F.least(F.greatest(ridge("stats"), F.lit(LOW)), F.lit(HIGH)) - LOW) / STEP)
    rows = chosen.groupBy(place.alias("bin")).agg(F.sum("mark"), F.count("*")).orderBy("bin").collect()
    model.calibrate(*(np.array(x, float) for x in zip(*rows)))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fold, score) of every document; rows of fold 0 are not learned from."""
    shared_dir(docs.sparkSession)
    stats = document_statistics(docs.select("doc_id", fold(FOLDS).alias("fold"), text), text).drop(text).checkpoint()
    model = fit(stats, labels)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(model.scores(_matrix(column)))

    return stats.select("doc_id", "fold", score("stats").alias("score"))
