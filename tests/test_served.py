"""Nearest neighbours at any number of questions, owners and hits: plans and results."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.operators import topk
from gleanery.operators.embedding import HashedWords, embed_chunks
from gleanery.operators.topk import nearest, nearest_rows
from gleanery.plans.retrieve import prompts, retrieve
from gleanery.sources.buckets import bucket_count, read_bucketed, write_bucketed
from gleanery.sources.store import Store
from tests.test_streams import EMBEDDER, MESSAGE, body, page
from tests.test_topk import ASKED, DOCS, OWNED, brute, case, found

DOUBLES = "id string, embed array<double>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def below(text: str, at: int) -> str:
    """The part of a plan under the node in a line, by its indentation."""
    lines = text.split("\n")
    depth = lambda line: len(re.match(r"[ :+\-|*()\d]*", line)[0])
    rest = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        rest.append(line)
    return "\n".join(rest)


def exchanged(df, column: str) -> bool:
    """Whether a shuffle lies above a file scan that reads the column."""
    text = plan(df)
    lines = text.split("\n")
    return any(
        re.search(r"FileScan[^\[]*\[[^\]]*\b" + column + "#", below(text, n)) is not None
        for n, line in enumerate(lines)
        if "Exchange hashpartitioning(id" in line or "Exchange hashpartitioning(document_id" in line
    )


@pytest.fixture(scope="module")
def asked_docs_owned():
    return case(11, 250, 30, copies=20)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory, asked_docs_owned):
    _, docs, _ = asked_docs_owned
    rows = spark.createDataFrame([(d, v, f"text of {d}") for d, v in docs], DOCS + ", chunk string")
    return write_bucketed(rows, str(tmp_path_factory.mktemp("kept") / "docs"), "id", 4)


def test_one_scan_of_the_vectors_and_no_exchange(spark, kept, asked_docs_owned):
    asked, docs, owned = asked_docs_owned
    questions, edges = spark.createDataFrame(asked, ASKED), spark.createDataFrame(sorted(owned) * 2, OWNED)
    for owner_bytes in (topk.OWNER_BYTES, 0):
        got = nearest(questions, kept, 7, edges, owner_bytes=owner_bytes)
        assert plan(got).count("FileScan") == 1 and not exchanged(got, "embed")
        assert found(got) == brute(asked, docs, 7, owned)
    only = nearest(questions.where("user_id <> ''"), kept, 7, edges, owner_bytes=0)
    assert "Inner" in plan(only) and not exchanged(only, "embed")
    assert found(only) == brute([a for a in asked if a[1]], docs, 7, owned)


def test_chunks_are_never_exchanged(spark, kept, asked_docs_owned):
    asked, docs, owned = asked_docs_owned
    questions, edges = spark.createDataFrame(asked, ASKED), spark.createDataFrame(sorted(owned), OWNED)
    for few in (topk.FEW_HITS, 0):
        for owner_bytes in (topk.OWNER_BYTES, 0):
            rows = nearest_rows(questions, kept, ["chunk"], 7, edges, owner_bytes=owner_bytes, few_hits=few)
            assert not exchanged(rows, "chunk")
            assert all(r.chunk == f"text of {r.document_id}" for r in rows.collect())
            assert found(rows) == brute(asked, docs, 7, owned)


def test_documents_without_buckets_give_the_same(spark, asked_docs_owned):
    asked, docs, owned = asked_docs_owned
    rows = spark.createDataFrame([(d, v, f"text of {d}") for d, v in docs], DOCS + ", chunk string").repartition(6)
    questions, edges = spark.createDataFrame(asked, ASKED), spark.createDataFrame(sorted(owned), OWNED)
    got = nearest_rows(questions, rows, ["chunk"], 7, edges, owner_bytes=0, few_hits=0)
    assert found(got) == brute(asked, docs, 7, owned)


def test_the_check_of_plans_sees_an_exchange(spark, tmp_path, asked_docs_owned):
    """Plain files of the same rows do need one, so the checks above mean something."""
    asked, docs, owned = asked_docs_owned
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/plain")
    edges = spark.createDataFrame(sorted(owned), OWNED)
    got = nearest(spark.createDataFrame(asked, ASKED), spark.read.parquet(f"{tmp_path}/plain"), 7, edges, owner_bytes=0)
    assert exchanged(got, "embed")


def test_rows_of_many_tasks_are_merged_in_two_stages(spark, monkeypatch):
    asked, docs, _ = case(4, 400, 5, users=0)
    seen = []
    whole = topk._ranked
    monkeypatch.setattr(topk, "_ranked", lambda partial, k: seen.append(partial) or whole(partial, k))
    monkeypatch.setattr(topk, "FAN_IN", 4)
    got = nearest(spark.createDataFrame(asked, ASKED), spark.createDataFrame(docs, DOCS).repartition(40), 3)
    assert plan(got).count("Exchange hashpartitioning(qid") == 2
    assert found(got) == brute(asked, docs, 3)
    groups = seen[0].groupBy("qid", "part").count().collect()
    assert max(g["count"] for g in groups) <= 4 * 3 and len({g.part for g in groups}) == 10


def test_doubles_stay_doubles(spark):
    """Vectors that differ far below single precision, and ones beyond its range."""
    docs = [(f"d{n:02}", [1.0 + n * 1e-12, 0.5]) for n in range(30)] + [("far", [1e200, 0.0])]
    asked = [("q", "", [1.0 + 29 * 1e-12, 0.5]), ("r", "", [1e200, 1.0])]
    got = nearest(spark.createDataFrame(asked, ASKED.replace("float", "double")), spark.createDataFrame(docs, DOUBLES), 3)
    ranks = {(r.qid, r.rank): r.document_id for r in got.collect()}
    assert [ranks["q", n] for n in (1, 2, 3)] == ["d29", "d28", "d27"] and ranks["r", 1] == "far"
    mixed = nearest(spark.createDataFrame([("q", "", [1.0, 0.5])], ASKED), spark.createDataFrame(docs, DOUBLES), 2)
    assert [r.document_id for r in mixed.orderBy("rank").collect()] == ["d00", "d01"]


def test_doubles_are_narrowed_without_a_loss():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(3000, 12)) * 1e-3 + 5
    q = vectors[rng.integers(0, 3000, 40)] + rng.normal(size=(40, 12)) * 1e-9
    asked = {"qids": np.arange(40).astype(str).astype(object), "vectors": q, "scopes": [""], "starts": np.array([0]), "counts": np.array([40])}
    best = topk._Best(asked, 5)
    ids = np.array([f"{n:04}" for n in range(3000)], dtype=object)
    for at in range(0, 3000, 700):
        best.offer(ids[at : at + 700], vectors[at : at + 700], None)
    gaps = ((q[:, None] - vectors[None]) ** 2).cumsum(axis=2)[:, :, -1]
    want = {(i, ids[j]) for i, row in enumerate(gaps) for j in np.lexsort((ids, row))[:5]}
    assert set(zip(best.rows["q"], best.rows["id"])) == want


def test_other_vectors_are_refused(spark):
    whole = spark.createDataFrame([("d", [1])], "id string, embed array<int>")
    with pytest.raises(ValueError, match="array<int>"):
        nearest(spark.createDataFrame([("q", "", [1.0])], ASKED), whole)


def test_a_document_that_every_user_owns(monkeypatch):
    """Batches with too many pairs are halved."""
    monkeypatch.setattr(topk, "PAIR_BLOCK", 50)
    rng = np.random.default_rng(3)
    q, vectors = rng.normal(size=(60, 4)).astype(np.float32), rng.normal(size=(25, 4)).astype(np.float32)
    scopes = [f"u{n:02}" for n in range(30)]
    asked = {"qids": np.arange(60).astype(str).astype(object), "vectors": q, "scopes": scopes, "starts": np.arange(0, 60, 2), "counts": np.full(30, 2)}
    owners = [list(range(30)) if n % 3 else [n] for n in range(25)]
    best = topk._Best(asked, 2)
    ids = np.array([f"{n:02}" for n in range(25)], dtype=object)
    best.offer(ids, vectors, pa.array(owners, pa.list_(pa.int32())))
    for i in range(60):
        mine = [n for n in range(25) if i // 2 in owners[n]]
        dist = {n: ((q[i].astype(float) - vectors[n].astype(float)) ** 2).cumsum()[-1] for n in mine}
        assert set(best.rows[best.rows["q"] == i]["id"]) == {ids[n] for n in sorted(mine, key=lambda n: (dist[n], ids[n]))[:2]}


def test_bounds_are_parameters_of_retrieval(spark, tmp_path):
    embedder = HashedWords(32)
    texts = [(f"p{n}_0", f"p{n}", " ".join(f"w{n * m % 17}" for m in range(9))) for n in range(60)]
    docs = embed_chunks(spark.createDataFrame(texts, "id string, url_key string, chunk string"), embedder)
    own = spark.createDataFrame([(f"p{n}_0", f"u{n % 4}") for n in range(60)], OWNED)
    questions = spark.createDataFrame([(str(n), f"w{n} w{n + 1}", ["", "u1", "u3"][n % 3]) for n in range(20)], "qid string, prompt string, user_id string")
    want = sorted(map(tuple, retrieve(questions, docs, own, embedder).collect()))
    bucketed = write_bucketed(docs, f"{tmp_path}/docs", "id", 2)
    for frame in (docs, bucketed):
        got = retrieve(questions, frame, own, embedder, broadcast_bytes=9_000, owner_bytes=0, few_hits=0)
        assert sorted(map(tuple, got.collect())) == want
    one = {r.qid: r.model_input for r in prompts(questions, docs, own, embedder, "{}|{}").collect()}
    two = {r.qid: r.model_input for r in prompts(questions, bucketed, own, embedder, "{}|{}", broadcast_bytes=9_000, owner_bytes=0, few_hits=0).collect()}
    assert one == two


def test_buckets_are_read_by_another_session(spark, tmp_path):
    rows = spark.range(300).selectExpr("cast(id as string) id", "struct(id as `a b`, array(id) as c) nested", "cast(null as double) `od``d`")
    folder = f"{tmp_path}/it's here"
    write_bucketed(rows, folder, "id", 8)
    other = spark.newSession()
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_") and spark.table(t.name).columns == rows.columns)
    spark.sql(f"DROP TABLE {name}")
    back = read_bucketed(other, folder)
    assert back.schema.simpleString() == rows.schema.simpleString() and back.count() == 300
    joined = back.join(other.range(300).selectExpr("cast(id as string) id", "id n").hint("shuffle_hash"), "id")
    assert plan(joined).count("Exchange") == 1 and joined.where("nested.`a b` = n").count() == 300


def test_bucket_count(spark, monkeypatch):
    from gleanery.sources import buckets

    rows = spark.range(1000).selectExpr("cast(id as string) id")
    assert bucket_count(rows) == 1 == bucket_count(rows.limit(0))
    monkeypatch.setattr(buckets, "BUCKET_BYTES", 10_000)
    assert bucket_count(rows) == 8
    monkeypatch.setattr(buckets, "MOST_BUCKETS", 4)
    assert bucket_count(rows) == 4


def test_a_store_serves_its_documents(spark, tmp_path):
    from gleanery.operators import messages as m
    from gleanery.plans.build_index import build_index

    store = Store(spark, f"{tmp_path}/store")
    rows = [(f"p{n}", page(f"http://h{n}.org", body(400 + n, f"x{n}y"), f"u{n % 3}"), n) for n in range(6)]
    build_index(m.parse_page_events(spark.createDataFrame(rows, MESSAGE)), store, EMBEDDER, run=1)
    served = store.serve_documents("served-1", buckets=2)
    columns = ["id", "url_key", "chunk", "offset"]
    want = sorted(map(tuple, store.documents().select(*columns).collect()))
    assert sorted(map(tuple, served.select(*columns).collect())) == want
    assert sorted(map(tuple, Store(spark, store.root).served_documents("served-1").select(*columns).collect())) == want
    questions = spark.createDataFrame([("1", "x1y3 x1y4", ""), ("2", "x2y1", "u2")], "qid string, prompt string, user_id string")
    hits = retrieve(questions, served, store.ownership(), EMBEDDER, owner_bytes=0, few_hits=0)
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, retrieve(questions, store.documents(), store.ownership(), EMBEDDER).collect()))
    assert not exchanged(hits, "chunk") and hits.where(F.col("rank") == 1).count() == 2


def test_questions_beyond_the_bound_never_pass_the_driver(spark, kept, monkeypatch, asked_docs_owned):
    """They meet the vectors in one job, which exchanges no vector of a document."""
    asked, docs, owned = asked_docs_owned
    asked = asked + [(f"more{n}", f"u{n % 300}", docs[n][1]) for n in range(250)]  # more users than a filter lists
    owned = owned | {(docs[n][0], f"u{n % 300}") for n in range(250)}
    questions, edges = spark.createDataFrame(asked, ASKED), spark.createDataFrame(sorted(owned), OWNED)
    monkeypatch.setattr(type(questions), "toArrow", lambda self: pytest.fail("questions are sent to the driver"))
    for owner_bytes in (topk.OWNER_BYTES, 0):
        for some in (questions, questions.where("user_id <> ''"), questions.where("user_id = ''")):
            qids = {r.qid for r in some.collect()}
            got = nearest(some, kept, 7, edges, broadcast_bytes=len(qids) * 600, owner_bytes=owner_bytes)
            assert plan(got).count("CartesianProduct") == 1 and not exchanged(got, "embed")
            assert found(got) == brute([a for a in asked if a[0] in qids], docs, 7, owned)


def test_doubles_in_blocks(spark):
    docs = [(f"d{n:02}", [1.0 + n * 1e-12, 0.5]) for n in range(30)] + [("far", [1e200, 0.0])]
    asked = [(f"q{n}", "", [1.0 + 29 * 1e-12, 0.5]) for n in range(20)] + [("r", None, [1e200, 1.0])]
    got = nearest(spark.createDataFrame(asked, ASKED.replace("float", "double")), spark.createDataFrame(docs, DOUBLES).coalesce(2), 3, broadcast_bytes=8000)
    ranks = {(r.qid, r.rank): r.document_id for r in got.collect()}
    assert [ranks["q7", n] for n in (1, 2, 3)] == ["d29", "d28", "d27"] and ranks["r", 1] == "far" and len(ranks) == 63
