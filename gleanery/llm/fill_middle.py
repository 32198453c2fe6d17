"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a sequence of units, ``[A-Za-z]+`` or one other character. One full match of
``(unit)*`` keeps every repetition of its group, so that ``match.ends(1)`` holds the end of
each unit: its length is the number of units, and both cuts are looked up in it. Where a
text is cut and which form it takes comes from a hash of its id, so the result does not
depend on how rows are dealt. Texts go to Python and only three numbers come back; the
pieces are put together, and taken apart again, by SQL functions.

A null text is an empty one; an empty text, and one that holds a marker itself, stays plain.
Rows that repeat an id are cut by the same hash, each by its own text; a row without an id is
hashed like an id of no characters. Ties do not arise: both cuts may be equal, and the middle
is empty then. A text of more than ``SLICE`` characters is matched in slices that end beside
a character that is no letter, which no unit crosses, so memory is bounded but for one
number for each unit. An empty table gives an empty one. Columns are kept as they are; one
named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

# fixed values: the unit and the markers
UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_BORDER = regex.compile(r"[^A-Za-z]")

SLICE = 1 << 20  # characters matched at once


def unit_ends(text: str, limit: int = SLICE) -> Sequence[int]:
    """Where each unit of the text ends."""
    if len(text) <= limit:
        return UNITS.fullmatch(text).ends(1)
    parts, begin = [], 0
    while begin < len(text):
        border = _BORDER.search(text, begin + limit - 1)
        if begin + limit >= len(text) or border is None:
            end = len(text)
        else:  # before the border, or after it where it is the slice's last character
            end = max(border.start(), begin + limit)
        parts.append(np.array(UNITS.fullmatch(text, begin, end).ends(1), np.int64))
        begin = end
    return np.concatenate(parts)


_CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "start", "end")])


@F.arrow_udf(_CUTS)
def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The number of units, and the two cuts as numbers of characters."""
    for texts, one, two in batches:
        counts, starts, ends = [], [], []
        for text, h, k in zip(texts.to_pylist(), one.to_pylist(), two.to_pylist()):
            at = unit_ends(text)
            n = len(at)
            low, high = sorted((h % (n + 1), k % (n + 1)))
            counts.append(n)
            starts.append(int(at[low - 1]) if low else 0)
            ends.append(int(at[high - 1]) if high else 0)
        columns = [pa.array(c, pa.int64()) for c in (counts, starts, ends)]
        yield pa.StructArray.from_arrays(columns, ["n", "start", "end"])


def _number(digest: Column, place: int) -> Column:
    """The place-th group of eight hex digits as a number."""
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
    into: str = "fim",
) -> DataFrame:
    """The documents with a struct ``n, form, output, prefix_chars, middle_chars``: the number
    of units; ``plain``, ``psm`` or ``spm``; the text in that form; and the lengths of prefix
    and middle in characters, null where plain. Of 100 documents ``plain_percent`` stay
    plain, and of the others' hundred ``spm_percent`` give the suffix first."""
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    form = (
        F.when((whole == "") | marked | (_number(digest, 2) % 100 >= 100 - plain_percent), "plain")
        .when(_number(digest, 3) % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    cut = _cuts(whole, _number(digest, 0), _number(digest, 1))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = docs.select(row.alias("row"), form.alias("form"), cut.alias("cut"))
    whole = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    start, end = F.col("cut.start").cast("int"), F.col("cut.end").cast("int")
    prefix, middle = F.substring(whole, F.lit(1), start), F.substring(whole, start + 1, end - start)
    suffix = F.substring(whole, end + 1, F.lit((1 << 31) - 1))
    plain = F.col("form") == "plain"
    output = (
        F.when(plain, whole)
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    )
    result = F.struct(
        F.col("cut.n").alias("n"),
        "form",
        output.alias("output"),
        F.when(~plain, F.col("cut.start")).alias("prefix_chars"),
        F.when(~plain, F.col("cut.end") - F.col("cut.start")).alias("middle_chars"),
    )
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != into]
    return judged.select(*kept, result.alias(into))


def restore(output: Column, form: Column) -> Column:
    """The text, from its form alone. Cut texts hold no marker of their own, and none can
    arise where a piece meets a marker, so there are four parts."""
    part = lambda i: F.element_at(F.split(output, "<[PSM]>", -1), i)
    return (
        F.when(form == "psm", F.concat(part(2), part(4), part(3)))
        .when(form == "spm", F.concat(part(3), part(4), part(2)))
        .otherwise(output)
    )
