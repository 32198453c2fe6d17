"""Turn tables against a per-conversation model."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from gleanery.operators import conversations
from gleanery.operators.conversations import pair_turns, truncate_to_last_user

SCHEMA = "conv_id long, turn long, role string, text string"
FIXED = [
    (1, 0, "system"), (1, 1, "user"), (1, 2, "assistant"), (1, 3, "user"),
    (2, 0, "assistant"), (2, 1, "system"),
    (3, 0, "user"), (3, 5, "user"), (3, 9, "assistant"), (3, 40, "assistant"),
    (4, 3, "user"), (4, 4, "system"), (4, 5, "assistant"),
    (5, 7, "user"), (5, 8, "assistant"), (5, 31, "user"), (5, 64, "assistant"),
    (6, 5, "user"), (6, 5000, "assistant"), (6, 5001, "user"), (6, 9_000_000, "user"), (6, 40_000_000, "assistant"),
    (6, 40_000_001, "user"), (6, 40_000_002, "system"), (6, 90_000_000, "user"),
]


def table(spark, rows):
    return spark.createDataFrame([(*row, f"{row[0]}.{row[1]}") for row in rows], SCHEMA)


def model_pairs(rows):
    pairs = set()
    for conv in {row[0] for row in rows}:
        turns = sorted(row[1:] for row in rows if row[0] == conv)
        for (turn, role), (after, reply) in zip(turns, turns[1:]):
            if (role, reply) == ("user", "assistant"):
                pairs.add((conv, turn, f"{conv}.{turn}", f"{conv}.{after}"))
    return pairs


def model_cut(rows):
    last = {}
    for conv, turn, role in rows:
        if role == "user":
            last[conv] = max(turn, last.get(conv, turn))
    return {(c, t, r) for c, t, r in rows if t <= last.get(c, -1)}


@pytest.mark.parametrize("long,span", [(0, 1), (0, 2), (3, 3), (0, 8), (4, 1024), (1000, 2)])
def test_pairs_whatever_is_long(spark, long, span):
    got = pair_turns(table(spark, FIXED), long, span).collect()
    assert len(got) == len(model_pairs(FIXED))
    assert {tuple(r) for r in got} == model_pairs(FIXED)


@pytest.mark.parametrize("long", [0, 3, 1000])
def test_cut_after_the_last_user_turn(spark, long):
    got = truncate_to_last_user(table(spark, FIXED), long).collect()
    assert len(got) == len(model_cut(FIXED))
    assert {(r.conv_id, r.turn, r.role) for r in got} == model_cut(FIXED)


@pytest.mark.parametrize("long", [0, 1000])
def test_a_repeated_turn_is_one_turn(spark, long):
    rows = [(1, 1, "user"), (1, 2, "assistant"), (1, 2, "assistant"), (1, 3, "user"), (1, 3, "assistant"), (1, 4, "assistant")]
    assert [(r.turn, r.model_response) for r in pair_turns(table(spark, rows), long, 2).collect()] == [(1, "1.2")]


turns = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 30), st.sampled_from(["user", "assistant", "system"])),
    min_size=1, max_size=40, unique_by=lambda row: row[:2],
)


@pytest.fixture()
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(conversations, "SPAN", 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(turns, st.integers(1, 4))
def test_random_conversations_in_tiny_blocks(spark, tiny_blocks, rows, span):
    assert sorted(tuple(r) for r in pair_turns(table(spark, rows), 0, span).collect()) == sorted(model_pairs(rows))


@settings(max_examples=8, deadline=None)
@given(turns, st.integers(0, 15), st.integers(1, 6))
def test_random_conversations(spark, rows, long, span):
    df = table(spark, rows)
    assert sorted(tuple(r) for r in pair_turns(df, long, span).collect()) == sorted(model_pairs(rows))
    assert {(r.conv_id, r.turn, r.role) for r in truncate_to_last_user(df, long).collect()} == model_cut(rows)
