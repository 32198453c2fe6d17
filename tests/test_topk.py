"""Exact nearest neighbours against brute force, and the prompts made of them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.functions.vectors import checked_vector, squared_l2
from gleanery.operators import topk
from gleanery.operators.context import answer_block, assemble_context, evidence
from gleanery.operators.embedding import BatchModel, HashedWords, embed_chunks
from gleanery.operators.topk import nearest
from gleanery.plans.retrieve import prompts, retrieve

DOCS, ASKED, OWNED = "id string, embed array<float>", "qid string, user_id string, embed array<float>", "document_id string, user_id string"


def brute(asked, docs, k, owned=()):
    want = set()
    for qid, user, q in asked:
        mine = [(d, v) for d, v in docs if not user or (d, user) in owned]
        fold = lambda v: float(np.cumsum((np.float64(np.float32(q)) - np.float64(np.float32(v))) ** 2)[-1])
        ranked = sorted((fold(v), d) for d, v in mine)[:k]
        want |= {(qid, n + 1, d, dist) for n, (dist, d) in enumerate(ranked)}
    return want


def found(df):
    return {(r.qid, r.rank, r.document_id, r.dist) for r in df.collect()}


def case(seed, n_docs, n_asked, dim=16, copies=0, users=3):
    rng = np.random.default_rng(seed)
    docs = [(f"d{n}", rng.normal(size=dim).tolist()) for n in range(n_docs)]
    docs += [(f"copy{n}", docs[0][1]) for n in range(copies)]
    asked = [(f"q{n}", ["", "u1", "u2", "none"][n % (users + 1)], rng.normal(size=dim).tolist()) for n in range(n_asked)]
    asked += [("exact", "", docs[0][1])]
    owned = {(d, u) for d, _ in docs for u in ("u1", "u2") if rng.random() < 0.4}
    return asked, docs, owned


@pytest.mark.parametrize("k,n_docs,copies", [(7, 300, 0), (7, 3, 0), (3, 200, 150), (7, 1, 40), (1, 50, 5)])
@pytest.mark.parametrize("small_scope", [0, topk.SMALL_SCOPE])
def test_nearest_equals_brute_force(spark, monkeypatch, k, n_docs, copies, small_scope):
    monkeypatch.setattr(topk, "SMALL_SCOPE", small_scope)
    asked, docs, owned = case(k + n_docs, n_docs, 12, copies=copies)
    got = nearest(
        spark.createDataFrame(asked, ASKED),
        spark.createDataFrame(docs, DOCS).repartition(5),
        k,
        spark.createDataFrame(sorted(owned) * 2, OWNED),
    )
    assert found(got) == brute(asked, docs, k, owned)


def test_many_batches_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SMALL_SCOPE", 0)
    monkeypatch.setattr(topk, "PAIR_BLOCK", 500)
    asked, docs, _ = case(5, 900, 40, users=0)
    previous = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = found(nearest(spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS).repartition(2), 7))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", previous)
    assert got == brute(asked, docs, 7)


@pytest.mark.parametrize("scale", [1e-20, 1e12, 1e20])
def test_extreme_magnitudes(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SMALL_SCOPE", 0)
    rng = np.random.default_rng(1)
    docs = [(f"d{n}", (rng.normal(size=8) * scale).tolist()) for n in range(60)]
    asked = [(f"q{n}", "", (rng.normal(size=8) * scale).tolist()) for n in range(5)]
    got = nearest(spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS), 7)
    assert found(got) == brute(asked, docs, 7)


def test_near_ties_are_told_apart(spark, monkeypatch):
    """Distances differing in the last bits of a double still rank right."""
    monkeypatch.setattr(topk, "SMALL_SCOPE", 0)
    docs = [(f"d{n:03}", [1.0, float(np.float32(1e-4) * (n % 40)), 0.0]) for n in range(200)]
    asked = [("q", "", [1.0, 0.0, 0.0]), ("r", "", [0.0, 0.0, 0.0])]
    got = nearest(spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS), 7)
    assert found(got) == brute(asked, docs, 7)


def test_rounds_beyond_the_broadcast_bound(spark):
    asked, docs, owned = case(9, 120, 30)
    got = nearest(
        spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS), 7,
        spark.createDataFrame(sorted(owned), OWNED), broadcast_bytes=2000,
    )
    assert found(got) == brute(asked, docs, 7, owned)


def test_more_users_than_a_filter_lists(spark):
    rng = np.random.default_rng(3)
    docs = [(f"d{n}", rng.normal(size=4).tolist()) for n in range(40)]
    asked = [(f"q{n}", f"u{n}", rng.normal(size=4).tolist()) for n in range(300)]
    owned = {(d, f"u{n}") for n in range(0, 400, 3) for d, _ in docs[n % 7 :: 5]}
    got = nearest(
        spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS), 7,
        spark.createDataFrame(sorted(owned), OWNED),
    )
    assert found(got) == brute(asked, docs, 7, owned)


def test_no_questions_no_documents(spark):
    asked, docs, _ = case(1, 5, 2, users=0)
    a, d = spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS)
    assert nearest(a.limit(0), d).count() == 0
    assert nearest(a, d.limit(0)).count() == 0


def test_wrong_dimensions_fail(spark):
    asked = spark.createDataFrame([("q", "", [1.0, 2.0])], ASKED)
    with pytest.raises(Exception, match="dimensions"):
        nearest(asked, spark.createDataFrame([("d", [1.0])], DOCS)).collect()
    with pytest.raises(Exception, match="differ in length"):
        nearest(asked, spark.createDataFrame([("d", [1.0]), ("e", [1.0, 2.0])], DOCS).coalesce(1)).collect()
    with pytest.raises(Exception, match="expected 2 dimensions, got 1"):
        spark.createDataFrame([("d", [1.0])], DOCS).select(checked_vector(F.col("embed"), 2)).collect()


def test_scoped_questions_need_ownership(spark):
    with pytest.raises(ValueError, match="ownership"):
        nearest(spark.createDataFrame([("q", "u", [1.0])], ASKED), spark.createDataFrame([("d", [1.0])], DOCS))


def test_vectors_are_never_shuffled(spark):
    """Open questions: the only exchange is of the few ranked rows."""
    docs = spark.range(1000).selectExpr("cast(id as string) id", "array(cast(id as float)) embed")
    plan = nearest(spark.createDataFrame([("q", "", [1.0])], ASKED), docs)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_squared_l2(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [0.0, 4.0, 3.5])], "a array<float>, b array<float>")
    assert df.select(squared_l2(F.col("a"), F.col("b"))).first()[0] == 5.25


HITS = [("q", 2, "c2", "k"), ("q", 1, "c1", "k"), ("q", 10, "c10", "l"), ("r", 1, "only", "m")]


def test_context_and_evidence(spark):
    hits = spark.createDataFrame(HITS, "qid string, rank int, chunk string, url_key string")
    queries = spark.createDataFrame([("q", "Why?"), ("r", "{}"), ("none", "Who?")], "qid string, prompt string")
    got = {r.qid: r for r in assemble_context(hits, queries, "C:{} Q:{}!").collect()}
    assert got["q"].model_input == "C:c1\n\nc2\n\nc10 Q:Why?!"
    assert got["r"].model_input == "C:only Q:{}!"
    assert got["none"].model_input == "C: Q:Who?!" and got["none"].context == ""
    shown = {r.qid: r for r in evidence(hits).collect()}
    assert (shown["q"].chunks, shown["q"].urls) == ("c1\nc2\nc10", "k\nk\nl")
    answers = spark.createDataFrame([("q", "A"), ("none", "B")], "qid string, answer string")
    blocks = {r.qid: r.block for r in answer_block(answers, evidence(hits)).collect()}
    assert blocks["q"] == "🧠 Answer:\nA\n\n⏳ URL:\nk\nk\nl\n\n"
    assert blocks["none"] == "🧠 Answer:\nB\n\n⏳ URL:\n\n\n"


def test_template_needs_two_slots(spark):
    hits = spark.createDataFrame(HITS, "qid string, rank int, chunk string, url_key string")
    with pytest.raises(ValueError):
        assemble_context(hits, hits.selectExpr("qid", "chunk prompt"), "one {} slot")


def test_retrieve_and_prompts(spark):
    texts = [("a_0", "a", "red apples grow"), ("b_0", "b", "blue sky above"), ("c_0", "c", "red sky at night")]
    embedder = HashedWords(64)
    docs = embed_chunks(spark.createDataFrame(texts, "id string, url_key string, chunk string"), embedder)
    own = spark.createDataFrame([("b_0", "u"), ("c_0", "u")], OWNED)
    asked = spark.createDataFrame(
        [("1", "Red apples", ""), ("2", "red apples", "u"), ("3", "", ""), ("4", "sky", "nobody")],
        "qid string, prompt string, user_id string",
    )
    hits = retrieve(asked, docs, own, embedder, k=2)
    assert {(r.qid, r.rank, r.document_id) for r in hits.collect()} == {
        ("1", 1, "a_0"), ("1", 2, "c_0"), ("2", 1, "c_0"), ("2", 2, "b_0"),
    }
    rows = {r.qid: r for r in prompts(asked, docs, own, embedder, "{}|{}", k=1).collect()}
    assert set(rows) == {"1", "2", "4"}
    assert rows["1"].model_input == "red apples grow|Red apples" and rows["1"].urls == "a"
    assert rows["4"].model_input == "|sky" and rows["4"].chunks == ""


def test_embedders(spark):
    df = spark.createDataFrame([("one two two",), ("",)], "chunk string")
    hashed = [np.array(r.embed) for r in embed_chunks(df, HashedWords(32)).collect()]
    assert np.isclose((hashed[0] ** 2).sum(), 1) and not hashed[1].any() and len(hashed[1]) == 32

    def make_predict():
        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)

    model = [r.embed for r in embed_chunks(df, BatchModel(make_predict, dim=2, batch_size=1)).collect()]
    assert model == [[11.0, 2.0], [0.0, 0.0]]
