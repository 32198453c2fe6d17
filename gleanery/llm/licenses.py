"""License scans: a trained paragraph classifier, in DataFrame functions only.

Paragraphs are lines. Lines that state a licence by its name label a sample, with the
families' templates and a share of the other lines as class ``none``; the sample is bounded
by ``SAMPLE`` different lines for each class. Features are the words and word pairs that
occur in labelled statements. Multinomial logistic regression over these is fitted by
proximal gradient steps, which keep the weights sparse. Two probabilities are calibrated on
a fold of the sample that was not fitted: the one from which a line is a licence at all, so
that no line of class none is, and the one from which its family is believed. Below that,
and where the family's template does not confirm the prediction, a licence is ``unknown``.

The model is of bounded size and becomes a literal: scoring touches no other rows, and only
documents that hold a word of positive weight are looked at more closely, since no other
could be anything but ``none``. A null or empty text has no paragraphs. Without samples the
templates alone are learned from. Repeated rows are scanned one by one. A very long text is
scanned whole, in one task. Without rows nothing is returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.llm.texts import let
from gleanery.session import shared_dir

# fixed values: what statements of each family say, and the words that name it
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0",
}
NAMES = {
    "Apache-2.0": "apache license",
    "BSD-3-Clause": "bsd 3 clause",
    "CC-BY-4.0": "cc by 4 0",
    "CC-BY-NC-4.0": "cc by nc 4 0",
    "GPL-2.0": "general public license version 2",
    "GPL-3.0": "general public license version 3",
    "MIT": "mit license",
    "MPL-2.0": "mozilla public license",
}
FAMILIES = list(TEMPLATES)
CLASSES = ["none", *FAMILIES]
SAMPLE = 1000  # different lines of each class
NEGATIVES = 64  # one other line in so many is a candidate for class none
FEATURES = 512
STEPS, RATE, SPARSITY = 15, 6.0, 0.001
CONFIRMED = 0.7  # share of the template's word pairs found in the paragraph


def tokens(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def pairs(words: Column) -> Column:
    at = F.sequence(F.lit(0), F.size(words) - 2)
    return F.when(F.size(words) > 1, F.transform(at, lambda i: F.concat_ws(" ", words[i], words[i + 1]))).otherwise(F.array().cast("array<string>"))


def features(line: Column) -> Column:
    return let(tokens(line), lambda words: F.array_distinct(F.concat(words, pairs(words))))


def _named(line: Column) -> Column:
    """The class of a line by the name in it."""
    plain = F.concat(F.lit(" "), F.array_join(tokens(line), " "), F.lit(" "))
    return let(plain, lambda p: F.coalesce(*[F.when(p.contains(f" {n} "), F.lit(c)) for c, n in NAMES.items()], F.lit("none")))


def labelled_sample(docs: DataFrame, text: str = "text") -> DataFrame:
    """(line, label), the templates included."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line")).where("line != ''")
    spoken = F.lower("line").rlike("licen|apache|mit|bsd|cc |mozilla")
    kept = lines.where(spoken | (F.pmod(F.xxhash64("line"), F.lit(NEGATIVES)) == 0))
    named = kept.withColumn("label", F.when(spoken, _named(F.col("line"))).otherwise("none"))
    # of the lines without a name, those that merely look alike are sampled as all others
    named = named.where((F.col("label") != "none") | (F.pmod(F.xxhash64("line"), F.lit(NEGATIVES)) == 0))
    place = F.xxhash64("line", F.lit(1))
    different = named.groupBy("line", "label").agg(F.min(place).alias("place")).checkpoint()
    few = [different.where(F.col("label") == c).orderBy("place", "line").limit(SAMPLE) for c in CLASSES]
    spark = docs.sparkSession
    templates = spark.createDataFrame([(t, c) for c, t in TEMPLATES.items()], "line string, label string")
    return reduce(DataFrame.union, [f.select("line", "label") for f in few], templates)


@dataclass
class Model:
    weights: dict[str, list[float]]  # of each feature, by class
    bias: list[float]
    licensed: float  # a line is a licence if class none leaves more than this
    believed: float  # and of its family if that has as much


def _scores(found: DataFrame, weights: DataFrame, bias: list[float]) -> DataFrame:
    sums = found.join(weights, "feature", "left").groupBy("line", "label", "fold")
    sums = sums.agg(*[F.sum(F.coalesce(f"w{i}", F.lit(0.0))).alias(f"z{i}") for i in range(len(CLASSES))])
    z = [F.col(f"z{i}") + b for i, b in enumerate(bias)]
    top = F.greatest(*z)
    total = reduce(Column.__add__, [F.exp(x - top) for x in z])
    return sums.select("line", "label", "fold", *[(F.exp(x - top) / total).alias(f"p{i}") for i, x in enumerate(z)])


def train(docs: DataFrame, text: str = "text") -> Model:
    shared_dir(docs.sparkSession)
    sample = labelled_sample(docs, text).checkpoint()
    sample = sample.select("line", "label", F.explode(F.array_append(features(F.col("line")), F.lit(""))).alias("feature"))
    template = F.col("line").isin(*TEMPLATES.values())
    sample = sample.withColumn("fold", F.when(template, 1).otherwise(F.pmod(F.xxhash64("line", F.lit(2)), F.lit(5)).cast("int")))
    known = sample.where("label != 'none' and feature != ''").groupBy("feature").agg(F.count("*").alias("n"))
    known = known.orderBy(F.desc("n"), "feature").limit(FEATURES).select("feature")
    # a line's bias term keeps the lines that have none of the features
    found = sample.join(F.broadcast(known), "feature", "left_semi").union(sample.where("feature = ''").select("feature", "line", "label", "fold"))
    found = found.checkpoint()
    k = range(len(CLASSES))
    # each class counts alike, however many lines it has
    sizes = dict(found.where("feature = '' and fold != 0").groupBy("label").count().collect())
    share = F.coalesce(*[F.when(F.col("label") == c, F.lit(1.0 / n)) for c, n in sizes.items()], F.lit(0.0))
    weights = found.select("feature").distinct().select("feature", *[F.lit(0.0).alias(f"w{i}") for i in k])
    for _ in range(STEPS):
        judged = _scores(found.where("fold != 0"), weights, [0.0] * len(CLASSES))
        errors = judged.select("line", *[(share * ((F.col("label") == c).cast("double") - F.col(f"p{i}"))).alias(f"e{i}") for i, c in enumerate(CLASSES)])
        steps = found.where("fold != 0").join(errors, "line").groupBy("feature").agg(*[F.sum(f"e{i}").alias(f"g{i}") for i in k])
        moved = [F.col(f"w{i}") + RATE / len(CLASSES) * F.coalesce(f"g{i}", F.lit(0.0)) for i in k]
        shrunk = [F.signum(m) * F.greatest(F.abs(m) - F.when(F.col("feature") == "", 0.0).otherwise(RATE * SPARSITY), F.lit(0.0)) for m in moved]
        weights = weights.join(steps, "feature", "left").select("feature", *[s.alias(f"w{i}") for i, s in enumerate(shrunk)])
        weights = weights.repartition(1).checkpoint()  # FEATURES rows at most
    rows = {r["feature"]: [r[f"w{i}"] for i in k] for r in weights.collect()}  # FEATURES at most
    bias = rows.pop("", [0.0] * len(CLASSES))
    # the surest wrong predictions among the lines kept apart are not to be believed
    apart = _scores(found.where("fold = 0"), weights, [0.0] * len(CLASSES))
    best = F.greatest(*[f"p{i}" for i in k if i])
    right = reduce(Column.__or__, [(F.col("label") == c) & (F.col(f"p{i}") == best) for i, c in enumerate(CLASSES) if i])
    none = F.max(F.when(F.col("label") == "none", 1 - F.col("p0")))
    wrong = F.max(F.when((F.col("label") != "none") & ~right, best))
    limits = [min(max(0.5, x or 0.5), 0.99) for x in apart.agg(none, wrong).first()]
    return Model({f: w for f, w in rows.items() if any(w)}, bias, *limits)


def _judge(model: Model):
    """A struct of a line: its class, ``unknown`` included, and the family's probability."""
    table = F.create_map(*[x for f, w in sorted(model.weights.items()) for x in (F.lit(f), F.array(*[F.lit(v) for v in w]))])
    shapes = {c: F.array(*[F.lit(p) for p in _python_pairs(t)]) for c, t in TEMPLATES.items()}

    def of(found: Column, words_found: Column) -> Column:
        def add(acc, f):
            return let(F.try_element_at(table, f), lambda w: F.when(w.isNull(), acc).otherwise(F.zip_with(acc, w, lambda x, y: x + y)))

        z = F.aggregate(found, F.array(*[F.lit(b) for b in model.bias]), add)

        def chances(z):
            e = F.transform(z, lambda x: F.exp(x - F.array_max(z)))
            return let(e, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))

        def decide(p):
            def named(best):
                family = F.array(*[F.lit(c) for c in FAMILIES])[F.array_position(F.slice(p, 2, len(FAMILIES)), best).cast("int") - 1]
                confirmed = reduce(
                    Column.__or__,
                    [
                        (family == c) & (F.size(F.array_intersect(shape, words_found)) >= CONFIRMED * F.size(shape))
                        for c, shape in shapes.items()
                    ],
                )
                name = F.when(1 - p[0] <= model.licensed, "none").when((best >= model.believed) & confirmed, family).otherwise("unknown")
                return F.struct(name.alias("license"), best.alias("probability"))

            return let(F.array_max(F.slice(p, 2, len(FAMILIES))), named)

        return let(let(z, chances), decide)

    return lambda line: let(features(line), lambda f: of(f, f))


def _python_pairs(template: str) -> list[str]:
    words = [w for w in "".join(c if c.isalnum() else " " for c in template.lower()).split()]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def license_scan(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """The documents' columns and ``licenses``: paragraph (line number from 0), license and
    probability of every line that is not of class none."""
    model = model or train(docs, text)
    kind = "array<struct<paragraph:int,license:string,probability:double>>"
    helpful = sorted({w for f, ws in model.weights.items() if max(ws[1:]) > 0 for w in f.split(" ")})
    cues = r"(?i)(?<![a-z0-9])(?:" + "|".join(helpful) + r")(?![a-z0-9])" if helpful else "$^"
    judge = _judge(model)
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    near = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("paragraph"), line.alias("line"))), lambda x: x["line"].rlike(cues))
    judged = F.transform(near, lambda x: F.struct(x["paragraph"].alias("paragraph"), judge(x["line"]).alias("j")))
    named = F.transform(
        F.filter(judged, lambda x: x["j"]["license"] != "none"),
        lambda x: F.struct(x["paragraph"].alias("paragraph"), x["j"]["license"].alias("license"), x["j"]["probability"].alias("probability")),
    )
    return docs.withColumn("licenses", F.when(F.col(text).rlike(cues), named).otherwise(F.array()).cast(kind))
