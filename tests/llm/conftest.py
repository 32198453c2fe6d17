from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, hits string, spans string, quality string, n bigint"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, empty, null, short and long texts, odd characters."""
    base, passage = words(1, 150), words(2, 60)
    parts = base.split(" ")
    rows: list[tuple[int | None, str | None]] = [(i, words(100 + i, 80) + ".\n" + words(200 + i, 30)) for i in range(8)]
    rows += [(10, base), (11, base), (12, " ".join([*parts[:75], "other", *parts[76:]]).upper()), (13, " ".join(parts[:120]))]
    rows += [(14, words(3, 40) + " " + passage), (15, passage + "\n" + words(4, 70)), (16, words(5, 5) + passage + words(6, 9))]
    rows += [(17, ""), (18, None), (19, " \n\t "), (20, "one two"), (21, "One  TWO"), (22, "ñandú Ünder straße \x85\x1c x"), (23, "a" * 3000)]
    rows += [(24, "\n".join([words(7, 8)] * 12)), (25, words(8, 4000)), (26, "same line\nsame line\n\nsame line " + base[:300])]
    rows += [(30, f"x {passage[:120]} tail"), (31, words(9, 60) + "🙂" * 30), (32, "🙂" * 40)]
    return rows


def table(spark, rows):
    """The rows as documents, with extra columns of clashing names."""
    full = [(d, t, "en", f"s{(d or 0) % 3}" if d != 5 else None, len(t or ""), "h", "s", "q", 1) for d, t in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return table(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows without an id, and rows repeated with one id."""
    text = words(50, 60)
    return table(spark, [(None, text), (None, None), (1, text), (1, text), (1, words(51, 60)), (2, text)])


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, []).limit(0)
