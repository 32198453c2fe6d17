"""Quality rules of documents and of their hosts, in DataFrame functions only.

A document fails by itself with too few words or too many repeated three-word windows.
Failures are counted for each host; its rate is shrunk towards the rate of all hosts by a
beta prior fitted to the hosts' counts, so that a host of few documents is not condemned
for two bad ones. Documents of a host whose shrunk rate is beyond the limit are rejected
with it.

A null or empty text has no words and fails. A document without a host is judged by its own
words alone. Repeated rows are judged, and counted, one by one. Without documents there are
no hosts and nothing is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleanery.llm.texts import let
from gleanery.operators.sizing import broadcast_if_small
from gleanery.session import scratch_path, shared_dir

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
HOST_LIMIT = 0.8  # shrunk failure rate beyond which a host is rejected
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"


def _repeated(words: Column) -> Column:
    """Number of words inside three-word windows found twice or more.

    A window's hash and position share a long; sorted, equal windows become neighbours,
    whose words are compared. The positions found are sorted and their reaches added up,
    so the work is n log n however repetitive the text is.
    """
    n = F.size(words)
    bits = F.length(F.bin(n))  # enough for any position

    def packed(i):
        i = i.cast("int")
        return F.call_function("shiftleft", F.xxhash64(words[i], words[i + 1], words[i + 2]), bits).bitwiseOR(i.cast("bigint"))

    keys = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed))

    def place(key):
        return key.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1).cast("int")

    def flagged(keys):
        def equal(a, b):
            same_hash = F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits)
            p, q = place(a), place(b)
            same_words = (words[p] == words[q]) & (words[p + 1] == words[q + 1]) & (words[p + 2] == words[q + 2])
            return F.when(same_hash, same_words).otherwise(False)

        def twice(key, i):
            before = F.when(i > 0, equal(F.get(keys, i - 1), key)).otherwise(False)
            return before | F.when(i < F.size(keys) - 1, equal(key, F.get(keys, i + 1))).otherwise(False)

        return F.sort_array(F.transform(F.filter(keys, twice), place))

    def reach(places):
        def add(acc, p):
            return F.struct((acc["n"] + F.least(F.lit(3), p + 3 - acc["end"])).alias("n"), (p + 3).alias("end"))

        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, add)["n"]

    return F.when(n < 3, 0).otherwise(let(let(keys, flagged), reach))


def document_stats(text: Column) -> Column:
    """A struct of ``STATS`` of a text."""
    body = F.coalesce(text, F.lit(""))

    def of(words):
        lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(_WORD))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeated(words).cast("bigint").alias("n_repeat_words"),
        )

    return let(F.filter(F.split(body, _SPACE + "+"), lambda w: w != ""), of)


def base_failed(stats: str = "stats") -> Column:
    words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words)


def host_rates(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n, n_failed, rate, shrunk) of every host. ``judged`` has a boolean ``failed``.

    The prior's mean is the failure rate of all documents; its strength comes from the
    spread of the hosts' rates beyond what chance explains (method of moments). Where
    chance explains it all, every host has the common rate.
    """
    hosts = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("n"), F.count_if(failed).alias("n_failed"))
        .checkpoint()  # a row for each host; the texts are not judged again for the sums
    )
    rate = F.col("n_failed") / F.col("n")
    sums = hosts.agg(
        F.sum("n").alias("N"), F.sum("n_failed").alias("K"), F.count("*").alias("H"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("N2"), F.sum(F.col("n_failed") * rate).alias("KP"),
    )
    mean = F.col("K") / F.col("N")
    within = mean * (1 - mean)
    # sum of n (rate - mean)^2 over the hosts, and what it would be by chance
    spread = F.col("KP") - F.col("K") * mean
    between = (spread - (F.col("H") - 1) * within) / (F.col("N") - F.col("N2") / F.col("N"))
    usable = (F.col("H") > 1) & (within > 0)
    strength = F.when(usable & (between > 0), F.greatest(within / between - 1, F.lit(1e-6))).otherwise(F.lit(1e9))
    mean, strength = sums.select(mean, strength).first()
    # without hosts there is no mean, and no row that it would be for
    shrunk = (F.col("n_failed") + F.lit(mean) * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "n_failed", rate.alias("rate"), shrunk.alias("shrunk"))


def quality_rules(
    docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT, into: str = "quality"
) -> DataFrame:
    """The documents' columns and a struct ``into``, which takes the place of a column of
    this name: the stats, base_failed, host_rate (the host's shrunk rate if beyond the
    limit, else null) and kept."""
    shared_dir(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() != into.lower()]
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    judged = docs.select(row.alias("row"), F.col(host).alias("from"), document_stats(F.col(text)).alias("stats"))
    judged = judged.withColumn("failed", base_failed("stats"))
    found = with_hosts(judged, limit)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in own], F.col("quality").alias(into))


def with_hosts(judged: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``judged``, with from, stats and failed, and the verdict ``quality`` on
    each, by itself and by its host."""
    bad = host_rates(judged, "from", "failed").where(F.col("shrunk") > limit).select("host", "shrunk")
    joined = judged.join(broadcast_if_small(bad), F.col("from") == F.col("host"), "left")
    quality = F.struct(
        *[F.col(f"stats.{s}").alias(s) for s in STATS],
        F.col("failed").alias("base_failed"),
        F.col("shrunk").alias("host_rate"),
        (~F.col("failed") & F.col("host").isNull()).alias("kept"),
    )
    return joined.select(*judged.columns, quality.alias("quality"))


def quality_scores(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(id, quality) of every document. The texts are read once: their narrow counts are
    kept in the shared folder, and both the hosts' rates and the verdicts come from those."""
    shared_dir(docs.sparkSession)
    judged = docs.select(F.col(id).alias("id"), F.col(host).alias("from"), document_stats(F.col(text)).alias("stats"))
    judged = judged.withColumn("failed", base_failed("stats")).checkpoint()
    return with_hosts(judged).select(F.col("id").alias(id), "quality")


def filter_quality(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass, with their own columns. The texts are judged once: those that
    do not fail by themselves are kept in the shared folder beside every document's verdict,
    from which the hosts are counted."""
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    stats = docs.select(row.alias("row"), F.col(host).alias("from"), document_stats(F.col(text)).alias("stats"))
    judged = stats.select("row", "from", base_failed("stats").alias("failed"))
    path = scratch_path(spark, "judged")
    judged.select(F.when(~F.col("failed"), F.col("row")).alias("row"), "from", "failed").write.parquet(path)
    judged = spark.read.parquet(path)
    bad = host_rates(judged, "from", "failed").where(F.col("shrunk") > limit).select("host")
    passed = judged.where(~F.col("failed")).join(broadcast_if_small(bad), F.col("from") == F.col("host"), "left_anti")
    return passed.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
