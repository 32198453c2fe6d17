"""The pipeline's stages, each against what it is to keep."""

from __future__ import annotations

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import corpus, table, words


def test_stages_and_run(spark, tmp_path):
    rows = [(d, t) for d, t in corpus()] + [(40, words(70, 60) + "\ntoken = " + "0123456789abcdef" * 2), (41, words(2, 60) + " " + words(71, 60))]
    docs = table(spark, rows)
    docs.drop("hits", "spans", "quality", "n").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, words(2, 60))]
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {d: t for d, t in rows if not brute.quality(t)[5]}
    near = {d: c for d, (_, c) in brute.near_components(kept, 5).items()}
    kept = {d: t for d, t in kept.items() if near[d] == d}
    hits = brute.passages(kept, items)
    kept = {d: t for d, t in kept.items() if not hits[d][1]}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(kept) and all(r.whole for r in got.values())
    assert 40 in got and 41 not in got and 11 not in got
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    masked = corpus_pipeline.secrets(spark, docs, str(tmp_path)).where("doc_id = 40").first()
    assert masked.text == words(70, 60) + "\n[secret]"
