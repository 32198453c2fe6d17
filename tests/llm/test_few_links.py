"""What connects the classes of crowds: a few edges for each class, by few joins."""

from __future__ import annotations

import re

from gleanery.llm import near_dedup
from gleanery.llm.near_dedup import components, near_duplicates
from tests.llm import brute
from tests.llm.conftest import table
from tests.llm.test_crowds import crowd


def test_a_crowd_is_connected_by_few_edges(spark, monkeypatch):
    found = []

    def noted(edges, most=None):
        out = components(edges, most)
        if most is not None:  # a crowd's bands
            found.append((edges.count(), edges.selectExpr("explode(array(a, b)) x").distinct().count(), most))
        return out

    monkeypatch.setattr(near_dedup, "components", noted)
    monkeypatch.setattr(near_dedup, "CROWD", 5)
    rows = crowd(1, 80, 2) + crowd(2, 60, 1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(table(spark, rows)).collect()}
    assert got == brute.near_components(dict(rows), 5)
    ((edges, classes, most),) = found
    assert classes >= 60 and most >= 4 * classes  # a class stands in several bands
    assert edges <= 2 * classes


def test_a_round_has_few_joins(spark, monkeypatch):
    plans = []
    kind = type(spark.range(0))
    checkpoint = kind.checkpoint

    def noted(self, *args, **kwargs):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return checkpoint(self, *args, **kwargs)

    monkeypatch.setattr(kind, "checkpoint", noted)
    path = [(i, i + 1) for i in range(20)] + [(j, 40 + i) for i in range(10) for j in (30, 40 + i // 2)]
    got = dict(map(tuple, components(spark.createDataFrame(path, "a bigint, b bigint")).collect()))
    # 30 and 40 to 49 are one component, the path from 0 to 20 another
    assert got == dict.fromkeys(range(21), 0) | dict.fromkeys([30, *range(40, 50)], 30)
    joins = [len(re.findall(r"\w+Join\b", plan)) for plan in plans]
    assert max(joins) == 3  # smaller neighbours: for the edges and for their least; larger ones
