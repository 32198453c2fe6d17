"""Fill-in-the-middle against a plain version, and back."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleanery.llm.fill_middle import fill_in_middle, restore, unit_ends
from tests.llm.conftest import table, words

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    """n, form, output, prefix and middle characters."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", text, None, None
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


MARKED = [(50, "a <P> b"), (51, "<S>"), (52, "x<M"), (53, "<<P"), (54, "P>S>M>"), (55, "<"), (56, "<P<S<M<"), (57, "\x00 a\r\nb"), (58, "<p> é")]


def test_documents(spark, rows):
    every = rows + MARKED + [(1000 + i, words(i, 7) + "<" * (i % 3)) for i in range(150)]
    docs = table(spark, every)
    fim = fill_in_middle(docs)
    assert fim.columns == [*docs.columns, "fim"]
    got = fim.withColumn("back", restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert {r.doc_id: tuple(r.fim) for r in got} == {d: plain(d, t) for d, t in every}
    texts = dict(every)
    assert all(r.back == (texts[r.doc_id] or "") for r in got)
    assert {r.fim.form for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(odd, empty):
    got = fill_in_middle(odd).collect()
    assert sorted(map(str, (tuple(r.fim) for r in got))) == sorted(str(plain(r.doc_id, r.text)) for r in got)
    assert fill_in_middle(empty).count() == 0


def test_a_column_of_the_result_name_is_replaced(odd):
    found = fill_in_middle(odd.withColumn("fim", F.lit(1)).withColumn("form", F.lit(2)).withColumn("row", F.lit(3)).withColumn("cut", F.lit(4)))
    assert found.columns == [*odd.columns, "form", "row", "cut", "fim"] and found.where("fim.n >= 0 and form = 2").count() == 6


def test_shares_are_parameters(spark, rows):
    docs = table(spark, [(i, "some text") for i in range(40)])
    assert {r.fim.form for r in fill_in_middle(docs, plain_percent=0, spm_percent=100).collect()} == {"spm"}
    assert {r.fim.form for r in fill_in_middle(docs, plain_percent=100).collect()} == {"plain"}


def test_a_very_long_text(spark):
    long = words(3, 300_000) + "é" * 1000 + "x" * 2_500_000 + " end"
    row = fill_in_middle(table(spark, [(1, long)]), plain_percent=0).first()
    assert tuple(row.fim) == plain(1, long)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abZ \n<é🙂0"), max_size=60), st.integers(1, 9))
def test_slices_do_not_matter(text, limit):
    want = [m.end() for m in UNIT.finditer(text)]
    assert list(unit_ends(text)) == want == list(unit_ends(text, limit))
