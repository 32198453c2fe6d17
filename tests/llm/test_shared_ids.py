"""Rows that share an id where near-duplicates are dropped."""

from __future__ import annotations

from gleanery.llm.near_dedup import drop_near_duplicates
from tests.llm.conftest import table, words


def test_only_the_copy_among_rows_of_one_id_goes(spark):
    copied, unique = words(90, 60), words(91, 60)
    near = copied.rsplit(" ", 1)[0] + " other"
    rows = [(3, copied), (5, copied), (5, unique), (6, near), (6, None), (None, copied), (7, words(92, 60))]
    kept = sorted((r.doc_id or 0, r.text or "") for r in drop_near_duplicates(table(spark, rows)).collect())
    assert kept == sorted([(0, copied), (3, copied), (5, unique), (6, ""), (7, words(92, 60))])
