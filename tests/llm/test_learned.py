"""Operators with a trained model, and the tokenizer: exact parts, round trips, accuracy."""

from __future__ import annotations

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleanery.llm import bpe, hmm, language, licenses, near_dedup, quality, secret_scan
from gleanery.llm.texts import WordHashes
from tests.llm import brute
from tests.llm.conftest import table, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec_of(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_of_documents(docs, odd, empty, rows, reference):
    got = {r.doc_id: r.bpe for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for d, text in rows:
        assert got[d].ids == reference.encode_ordinary(text or "") and got[d].decoded.decode() == (text or "")
    assert bpe.encode(odd, RANKS, public_tokenizers.PATTERN).where("bpe.decoded = cast(coalesce(text, '') as binary)").count() == 6
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    ids = docs.sparkSession.createDataFrame([([64, 65],), (None,), ([],)], "ids array<int>")
    back = [bytes(r.decoded) for r in bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()]
    assert back == [reference.decode_bytes([64, 65]), b"", b""]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=200), min_size=1, max_size=4))
def test_bpe_equals_the_public_library(texts):
    codec = bpe.codec_of(RANKS, public_tokenizers.PATTERN)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    ids, borders = codec.encode(texts)
    assert [x.tolist() for x in np.split(ids, borders[:-1])] == [encoding.encode_ordinary(t) for t in texts]
    assert codec.decode(ids, borders) == [t.encode() for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_both_contractions_agree(piece):
    codec = bpe.codec_of(RANKS, public_tokenizers.PATTERN)
    assert codec.pieces([piece])[0].tolist() == codec.contract(piece).tolist()


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(3)
    share = lambda *shape: (x := rng.random(shape)) / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(share(hmm.STATES), share(hmm.STATES, hmm.STATES), share(hmm.STATES, 5).T)
    texts = [np.array(x) for x in ([1, 0], [4, 2, 3, 0], [0])]
    for text, got in zip(texts, hmm.log10_likelihood(model, texts)):
        total = 0.0
        for path in itertools.product(range(hmm.STATES), repeat=len(text)):
            chance = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, o in zip(path, path[1:], text[1:]):
                chance *= model.moves[a, b] * model.emit[o, b]
            total += chance
        assert got == pytest.approx(np.log10(total))


def test_expected_counts_add_up():
    model = hmm.first_model(hmm.Vocabulary({}, [], 1, 1, 1, np.zeros((2, 1 + hmm.SHARED)), np.full(1 + hmm.SHARED, 1 / (1 + hmm.SHARED))))
    texts = [np.array([3, 4, 5, 0]), np.arange(1, 200), np.array([0])]
    starts = moves = emissions = 0
    for spans, firsts in hmm.spans_of(texts, 1 + hmm.SHARED):
        a, b, c = hmm.expected(model, spans, firsts)
        starts, moves, emissions = starts + a.sum(), moves + b.sum(), emissions + c.sum(axis=1)
    assert starts == pytest.approx(3) and moves == pytest.approx(3 + 198)
    assert emissions == pytest.approx(np.bincount(np.concatenate(texts), minlength=1 + hmm.SHARED))


def test_each_round_is_more_likely(spark):
    rng = random.Random(1)
    groups = ["aba aca ada afa".split(), "bob cob dob fob".split()]
    texts = [" ".join(rng.choice(groups[(i + j // 5) % 2]) for j in range(60)) for i in range(200)]
    docs, learn = table(spark, list(enumerate(texts))), F.col("doc_id") % 4 != 0
    sums = [hmm.score_texts(docs, learn, rounds=n).where(learn).agg(F.sum("score")).first()[0] for n in (0, 1, 3, 25)]
    assert sums == sorted(sums)
    held_out = hmm.score_texts(docs, learn, rounds=25).where(~learn).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held_out[0] > held_out[1] + 0.04 * held_out[2]


def test_shared_symbols_agree_with_sql(spark):
    some = [w.encode() for w in ("a", "ab", "abc", "abcd", "straße", "é")]
    df = spark.createDataFrame([(bytearray(w),) for w in some], "word binary")
    assert [r[0] for r in df.select(1 + F.crc32(F.substring("word", -3, 3)) % hmm.SHARED).collect()] == [hmm.shared_symbol(w) for w in some]


def test_estimates_are_near_the_overlap():
    one, two = np.unique(np.random.default_rng(1).integers(0, 2**63, 1300, dtype=np.uint64)), None
    one, two = one[:1000], np.sort(np.concatenate([one[100:1000], one[1000:1100]]))
    regs = [near_dedup.registers(x)[None] for x in (one, two)]
    assert near_dedup.estimate(*regs, np.array([1000.0]), np.array([1000.0]))[0] == pytest.approx(900 / 1100, abs=0.12)
    union = near_dedup.registers(np.unique(np.concatenate([one, two])))
    assert (union == np.maximum(*regs)[0]).all()  # registers merge
    assert len(near_dedup.shingle_set(b"", WordHashes(), 4)) == 0


def secrets_corpus(spark):
    rng = random.Random(2)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    plain = ["configuration", "initialization_vector", "user-defined-function", "internationalization", "the", "quick", "documents"]
    rows = [(i, " ".join(rng.choices(plain, k=60))) for i in range(300)]
    rows += [(1000 + i, f"é {' '.join(rng.choices(plain, k=9))} token = \"{mixed(40)}\" and {hexes(40)}") for i in range(100)]
    return rows + [(5000, f"see {mixed(40)} there"), (5001, None), (5002, "")], table(spark, rows + [(5000, f"see {mixed(40)} there"), (5001, None), (5002, "")])


def test_secrets(spark, odd, empty):
    rows, docs = secrets_corpus(spark)
    got = {r.doc_id: r.secrets for r in secret_scan.secret_spans(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for d, text in texts.items():
        base = [(s.start, s.end, s.kind) for s in got[d] if s.kind != "markov"]
        assert base == brute.base_secrets(text)
    assert [(s.kind, texts[5000][s.start : s.end]) for s in got[5000]] == [("markov", texts[5000].split(" ")[1])]
    assert not any(got[i] for i in range(300))
    clean = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert clean[5000].text == "see [secret] there" and clean[5000].n_chars == 18 and clean[5001].text is None
    assert all(clean[i].text == texts[i] for i in range(300))
    assert secret_scan.redact(docs).columns == docs.columns
    assert secret_scan.redact(odd).count() == 6 and secret_scan.redact(empty).count() == 0


def test_language_sums_over_segmentations():
    lattice = language.Lattice(PIECES)
    rng = np.random.default_rng(5)
    chances = rng.random((lattice.size, 2))
    chances[-1] = 0
    chances /= chances.sum(axis=0)

    def total(text, lang):
        if not text:
            return 1.0
        out = 0.0
        for k in range(1, min(language.LONGEST, len(text)) + 1):
            if (piece := lattice.ids.get(text[:k], 0 if k == 1 else None)) is not None:
                out += chances[piece, lang] * total(text[k:], lang)
        return out

    some = ["house", "a", "ñandú", "ж中x", "straße"]
    got = language.log_chances(lattice, chances, some)
    for w, row in zip(some, got):
        assert row == pytest.approx([np.log(total(language.START + w, i)) for i in range(2)])


def test_language_of_texts(spark, odd, empty):
    rng = random.Random(4)
    vocabulary = {"de": "der und schlange gebirge straße nicht", "fr": "le et montagne rivière être pas"}
    rows = [(i, " ".join(rng.choices(v.split(), k=12)), lang) for i in range(200) for lang, v in vocabulary.items()]
    docs = spark.createDataFrame([*rows, (900, "12 ² --", "de"), (901, None, "fr"), (902, "gebirge " * 4, None), (None, "le montagne", "fr")], "doc_id int, text string, lang string")
    model = language.train(docs, PIECES)
    got = {(r.doc_id, r.text): r for r in language.identify(docs, model, PIECES).collect()}
    assert all(got[d, t].language.lang_pred == lang for d, t, lang in rows)
    assert got[900, "12 ² --"].language.lang_pred == "und" == got[901, None].language.lang_pred
    assert got[902, "gebirge " * 4].language.lang_pred == "de" and 0.9 < got[902, "gebirge " * 4].language.score <= 1
    nothing = language.train(empty, PIECES)
    assert {r.language.lang_pred for r in language.identify(odd, nothing, PIECES).collect()} == {"und"}
    assert language.identify(empty, model, PIECES).count() == 0


def test_quality_classifier(spark, odd, empty):
    rows = [(i, words(i, 80) if i % 3 else words(i, 60).replace(" ", "*** ")) for i in range(600)] + [(None, "x"), (9999, "")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(500)] + [(3, None), (None, 1)], "doc_id int, quality int")
    got = quality.quality_scores(table(spark, rows), labels).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and 500 <= r.doc_id < 600)
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(empty, labels).count() == 0


def test_calibration_is_monotone():
    model = quality.Model(np.zeros(quality.N_STATS), np.ones(quality.N_STATS))
    model.calibrate(np.arange(6.0), np.array([0, 2, 1, 3, 2, 9.0]), np.array([4, 4, 4, 4, 4, 9.0]))
    assert model.levels == pytest.approx([0, 0.375, 0.375, 0.625, 0.625, 1])


def test_licenses(spark, odd, empty):
    rng = random.Random(6)
    names = list(licenses.TEMPLATES.values())
    rows = [(i, f"{words(i, 30)}\nthe work of {words(1000 + i, 20)}" + (f"\n{rng.choice(names)}." if i % 4 == 0 else "")) for i in range(200)]
    docs = table(spark, rows + [(901, None), (902, "")])
    model = licenses.train(docs)
    got = {r.doc_id: r.licenses for r in licenses.license_scan(docs, model=model).collect()}
    for d, text in rows:
        said = [f for f, t in licenses.TEMPLATES.items() if text.endswith(t + ".")]
        assert [x.license for x in got[d]] == said and [x.paragraph for x in got[d]] == [2] * len(said)
    assert got[901] == got[902] == []
    assert licenses.license_scan(odd, model=model).count() == 6
    assert licenses.license_scan(empty).count() == 0
