"""What near-duplicates write on the way: a file for each partition, by the rows they hold."""

from __future__ import annotations

import pytest

from gleanery.llm import near_dedup
from gleanery.llm.near_dedup import drop_near_duplicates, near_duplicates
from tests.llm import brute
from tests.llm.conftest import table
from tests.llm.test_crowds import crowd

MANY = 40  # partitions of an exchange


@pytest.fixture
def written(spark, monkeypatch):
    """(plan before it ran, partitions) of every checkpoint, where exchanges keep their partitions."""
    found, names = [], {"spark.sql.shuffle.partitions": str(MANY), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {name: spark.conf.get(name) for name in names}
    kind = type(spark.range(0))
    checkpoint = kind.checkpoint

    def noted(self, *args, **kwargs):
        plan = self._jdf.queryExecution().executedPlan().toString()
        out = checkpoint(self, *args, **kwargs)
        found.append((plan, out._jdf.queryExecution().toRdd().getNumPartitions()))
        return out

    monkeypatch.setattr(kind, "checkpoint", noted)
    for name, value in names.items():
        spark.conf.set(name, value)
    yield found
    for name, value in kept.items():
        spark.conf.set(name, value)


def test_few_rows_are_few_files_and_texts_meet_one_worker(spark, monkeypatch, written):
    monkeypatch.setattr(near_dedup, "CROWD", 5)
    rows = crowd(1, 40, 2) + crowd(2, 30, 1) + crowd(4, 4, 2)
    docs = table(spark, rows).repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    want = brute.near_components(dict(rows), 5)
    assert got == want
    assert any("FlatMapGroupsInArrow" in plan for plan, _ in written)
    kept = {r.doc_id for r in drop_near_duplicates(docs).collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d}
    assert max(plan.count("ArrowEvalPython") for plan, _ in written) == 1
    assert sum(n >= MANY for _, n in written) <= 2  # the full sets, once for each of the two
    assert sum(n for _, n in written) < 6 * len(written)
