"""How many pairs of classes are compared in a group of near copies."""

from __future__ import annotations

import pytest

from gleanery.llm import near_dedup
from gleanery.llm.near_dedup import near_duplicates
from tests.llm import brute
from tests.llm.conftest import table, words
from tests.llm.test_crowds import crowd


@pytest.mark.parametrize("copies", [40, 80])
def test_copies_meet_the_text_they_were_made_from(spark, monkeypatch, copies):
    """Two copies are too far apart for a link; each is near the text itself, in whatever place that stands."""
    pairs = []

    def noted(rows, most=None):
        out, n = counted(rows, most)
        if out.columns == ["a", "b"]:  # pairs, links and their edges
            pairs.append(n)
        return out, n

    counted = near_dedup.counted
    monkeypatch.setattr(near_dedup, "counted", noted)
    rows = crowd(1, copies, 2) + [(1500, words(1, 120))] + crowd(2, copies, 2) + [(2, words(2, 120))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(table(spark, rows)).collect()}
    assert got == brute.near_components(dict(rows), 5)
    assert {c for _, c in got.values()} == {1000, 2}
    assert sum(pairs) <= 3 * len(rows)  # a pair, a link and an edge of each
