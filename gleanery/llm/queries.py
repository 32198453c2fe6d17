"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from gleanery.llm.bpe import encode
from gleanery.llm.decontaminate import benchmark_hits, n_hit
from gleanery.llm.fill_middle import fill_in_middle, restore
from gleanery.llm.hmm import score_texts
from gleanery.llm.host_rules import STATS, quality_scores
from gleanery.llm.language import identify, train
from gleanery.llm.licenses import license_scan
from gleanery.llm.near_dedup import near_duplicates
from gleanery.llm.quality import quality_scores as classified_quality
from gleanery.llm.repeats import remove_repeats
from gleanery.llm.secret_scan import digest, secret_spans
from gleanery.llm.simhash import simhash_duplicates
from gleanery.llm.texts import fold, read
from gleanery.llm.whitening import whiten
from gleanery.session import shared_dir


def op1_hidden_markov(spark, sf_dir):
    scores = score_texts(read(spark, sf_dir, "documents"), fold(7) != 2)
    return scores.select(
        "doc_id", (~F.col("learned_from")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_host_quality(spark, sf_dir):
    shared_dir(spark)
    found = quality_scores(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"quality.{s}" for s in STATS], "quality.base_failed", "quality.kept", "quality.host_rate")


def op3_near_duplicates(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4)


def op4_secret_spans(spark, sf_dir):
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] != "markov")
    of_kind = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return secret_spans(read(spark, sf_dir, "documents")).select(
        "doc_id",
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
    )


def op5_language(spark, sf_dir):
    docs, path = read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    model = train(docs.where(fold(4) != 2), path)
    judged = identify(docs.withColumn("held_out", fold(4) == 2), model, path)
    return judged.select("doc_id", "held_out", "language.lang_pred", "language.score")


def op6_license_scan(spark, sf_dir):
    names = F.transform("licenses", lambda x: x["license"])
    return license_scan(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.size(F.filter(names, lambda x: x == "unknown")).cast("bigint").alias("n_unknown"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(names, lambda x: x != "unknown"))), ",").alias("families"),
        F.array_max(F.transform("licenses", lambda x: x["probability"])).alias("probability"),
    )


def op7_benchmark_passages(spark, sf_dir):
    hits = benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "hits.n_words",
        n_hit().alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (F.size("hits.items") > 0).alias("contaminated"),
    )


def op8_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = F.col("bpe.ids")
    return encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


def op9_repeated_bytes(spark, sf_dir):
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_quality_classifier(spark, sf_dir):
    scores = classified_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scores.select("doc_id", (F.col("fold") == 0).alias("held_out"), "score", predicted.alias("predicted"))


def op11_simhash(spark, sf_dir):
    return simhash_duplicates(read(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    """The deviation is null where it is beyond a long; the operator's is a decimal."""
    rows = whiten(read(spark, sf_dir, "embeddings"))
    entries = rows.select("*", F.posexplode("whitened").alias("at", "entry"))
    return entries.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        F.col("entry").alias("whitened"),
        F.get("explained", "at").alias("explained"),
        "identity_error",
    )


def op13_fill_in_middle(spark, sf_dir):
    fim = fill_in_middle(read(spark, sf_dir, "documents"))
    return fim.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("fim.output"), F.col("fim.form")).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_hidden_markov": op1_hidden_markov,
    "op2_host_quality": op2_host_quality,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_secret_spans": op4_secret_spans,
    "op5_language": op5_language,
    "op6_license_scan": op6_license_scan,
    "op7_benchmark_passages": op7_benchmark_passages,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_simhash": op11_simhash,
    "op12_whitening": op12_whitening,
    "op13_fill_in_middle": op13_fill_in_middle,
}


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_host_quality": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
stats AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d)
  LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM judged WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(k) AS k, count(*) AS h, sum(n * n) AS n2, sum(k * k / n) AS kp, sum(k) / sum(n) AS mean FROM hosts),
prior AS (SELECT mean, CASE WHEN h > 1 AND mean * (1 - mean) > 0 AND between_hosts > 0
    THEN greatest(mean * (1 - mean) / between_hosts - 1, 1e-6) ELSE 1e9 END AS strength
  FROM (SELECT *, (kp - k * mean - (h - 1) * mean * (1 - mean)) / (n - n2 / n) AS between_hosts FROM sums)),
bad AS (SELECT source, (k + mean * strength) / (n + strength) AS shrunk FROM hosts, prior WHERE shrunk > 0.8)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND shrunk IS NULL AS kept, shrunk AS host_rate
FROM judged LEFT JOIN bad USING (source)""",
    "op3_near_duplicates": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS ws FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE
  list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' '))) END AS shingles FROM d),
each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)""",
    "op7_benchmark_passages": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wanted AS (SELECT DISTINCT item, n, ws[i : i + n - 1] AS gram
  FROM (SELECT *, least(10, len(ws)) AS n FROM items WHERE len(ws) > 0 AND item IS NOT NULL), LATERAL (SELECT unnest(range(1, len(ws) - n + 2)) AS i)),
lengths AS (SELECT DISTINCT n FROM wanted),
grams AS (SELECT doc_id, n, i, ws[i : i + n - 1] AS gram FROM d, lengths, LATERAL (SELECT unnest(range(1, len(ws) - n + 2)) AS i)),
found AS (SELECT doc_id, item, n, i FROM grams JOIN wanted USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, LATERAL (SELECT unnest(range(0, n)) AS k) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (SELECT doc_id, t, units, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
}
