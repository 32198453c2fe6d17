"""Operators with an exact result, against brute force and in odd cases."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleanery.llm.decontaminate import benchmark_hits, decontaminate, n_hit
from gleanery.llm.hmm import score_texts
from gleanery.llm.host_rules import STATS, filter_quality, host_rates, quality_rules, quality_scores
from gleanery.llm.near_dedup import drop_near_duplicates, near_duplicates
from gleanery.llm.repeats import remove_repeats
from gleanery.llm.secret_scan import base_spans
from gleanery.llm.texts import fold
from tests.llm import brute
from tests.llm.conftest import table, words


def test_quality_rules(docs, rows):
    got = {r.doc_id: r.quality for r in quality_rules(docs).select("doc_id", "quality").collect()}
    for d, text in rows:
        assert (*[got[d][s] for s in STATS], got[d].base_failed) == brute.quality(text), d
    scored = {r.doc_id: r.quality for r in quality_scores(docs).collect()}
    assert scored == got


def test_quality_of_odd_rows(odd, empty):
    assert quality_rules(odd).count() == 6
    assert quality_rules(empty).count() == 0
    assert filter_quality(odd).columns == odd.columns
    assert quality_scores(empty).count() == 0


def test_bad_hosts_go_and_small_ones_are_shrunk(spark):
    rows = [(i, words(i, 60), "en", "good", 1) for i in range(60)]
    rows += [(100 + i, "short" if i < 58 else words(i, 60), "en", "bad", 1) for i in range(60)]
    rows += [(200, "short", "en", "tiny", 1), (201, words(999, 60), "en", None, 1)]
    found = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n int")
    kept = {r.doc_id for r in filter_quality(found).collect()}
    assert kept == {*range(60), 201}
    judged = found.withColumn("f", F.col("text") == "short")
    rates = {r.host: r for r in host_rates(judged, "source", "f").collect()}
    assert set(rates) == {"good", "bad", "tiny"} and rates["tiny"].rate == 1 > rates["tiny"].shrunk
    assert 0 < rates["good"].shrunk < rates["tiny"].shrunk and rates["bad"].shrunk > 0.8


def test_near_duplicates(docs, rows):
    want = brute.near_components(dict(rows), 4)
    got = {r.doc_id: r for r in near_duplicates(docs, shingle=4).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_chains_and_stars_of_near_duplicates(spark):
    chain, text = [], words(60, 100).split(" ")
    for i in range(30):
        text = [*text[3:], *words(1000 + i, 3).split(" ")]
        chain.append((i, " ".join(text)))
    rows = chain + [(100 + i, words(61, 120).replace(" ", f" n{i} ", 1)) for i in range(40)]
    got = {r.doc_id: r.component_id for r in near_duplicates(table(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in brute.near_components(dict(rows), 5).items()}
    assert len(set(got.values())) == 2


def test_near_duplicates_of_odd_rows(odd, empty):
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates(odd).collect())
    assert got == [(0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_duplicates(empty).count() == 0
    assert drop_near_duplicates(odd).count() == 5 and drop_near_duplicates(odd).columns == odd.columns


ITEMS = [(1, words(2, 60)), (2, "One two"), (3, None), (4, "..."), (None, words(100, 20)), (12, words(103, 10)), (1, words(104, 12))]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_benchmark_passages(spark, docs, rows, block):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = benchmark_hits(docs, items, block_bytes=block).select("doc_id", "hits.n_words", n_hit().alias("hit"), "hits.items")
    assert {r.doc_id: (r.n_words, r.hit, r["items"]) for r in got.collect()} == brute.passages(dict(rows), ITEMS)


def test_benchmark_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    nothing = items.limit(0)
    assert decontaminate(odd, items).count() == 6 == decontaminate(odd, nothing).count()
    assert decontaminate(empty, items).count() == 0
    assert decontaminate(odd, items).columns == odd.columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("a b c d e".split()), max_size=60), st.lists(st.sampled_from("a b c d e".split()), max_size=14))
def test_winnowing_misses_no_window(text, item):
    from gleanery.llm.decontaminate import Index
    from gleanery.llm.texts import WordHashes

    docs, items = {1: " ".join(text)}, [(7, " ".join(item))]
    n, spans, found = next(Index([("7", items[0][1].encode())]).search([docs[1].encode()], WordHashes()))
    assert (n, sum(s["end"] - s["start"] for s in spans), found) == brute.passages(docs, items)[1]


def test_repeats(docs, rows):
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    for d, (n, gone, spans, kept) in brute.repeats(dict(rows)).items():
        assert (got[d].n_bytes, got[d].n_bytes - len(got[d].kept), len(got[d].spans), bytes(got[d].kept)) == (n, gone, spans, kept), d


def test_repeats_of_odd_rows(odd, empty):
    got = sorted((r.doc_id or 0, r.n_bytes - len(r.kept) > 0) for r in remove_repeats(odd).collect())
    assert got == [(0, False), (0, False), (1, False), (1, False), (1, False), (2, True)]
    assert remove_repeats(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=90), min_size=1, max_size=6), st.sampled_from([40, 400]))
def test_anchors_of_pieces_are_those_of_the_text(parts, limit):
    from gleanery.llm.repeats import Powers, anchors, pieces

    text = ("".join(parts) * 9).encode()
    whole = anchors([(text, 0, len(text))], Powers(len(text) + 500))
    some = list(pieces(text, limit))
    part, at, anchor, context = anchors([p[1:] for p in some], Powers(len(text) * 20 + 500))
    offsets = [p[0] for p in some]
    assert {*zip(whole[1].tolist(), whole[3].tolist())} == {(a + offsets[p], c) for p, a, c in zip(part.tolist(), at.tolist(), context.tolist())}


def test_base_of_the_language_model(docs, rows):
    got = {r.doc_id: r for r in score_texts(docs, fold(7) != 2).collect()}
    for d, (n, known, total, score) in brute.base_scores(dict(rows)).items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.learned_from) == (n, known, total, brute.fold(d, 7) != 2)
        assert r.base_score == pytest.approx(score, rel=1e-9) and r.score < 0


def test_language_model_of_odd_rows(odd, empty):
    assert score_texts(odd, F.lit(True)).count() == 6
    assert {r.train_tokens for r in score_texts(odd, F.lit(False)).collect()} == {0}
    assert score_texts(empty, F.lit(True)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "API_KEY", "api", "_key", "=", ":", " ", '"', "'", "abcdefgh", "x1", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "ſecret", "\n", "passwd"]), max_size=14))
def test_base_secrets(parts):
    text = "".join(parts)
    kinds = ("assign", "access", "hex")
    assert [(s, e, kinds[k]) for s, e, k, _ in base_spans(text)] == brute.base_secrets(text)
