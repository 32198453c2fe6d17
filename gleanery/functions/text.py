"""Text expressions: cleaning, words, URL spotting. All run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Whitespace as Python's `\s` / `str.split` see it. Java's `(?U)\s` is
# Unicode White_Space, which lacks the four information separators.
SPACE_CLASS = r"\s\x1c-\x1f"

# Fixed value: URL pattern of the crawl box.
URL_PATTERN = rf'(?U)\bhttps?://[^{SPACE_CLASS}<>"]+|www\.[^{SPACE_CLASS}<>"]+\b'


def clean_text(text: Column) -> Column:
    """Flatten whitespace (and literal ``\\t`` / ``\\n``), then drop ``[digits]`` and trim.

    Citations go after the collapse, so ``a [1] b`` keeps two spaces. The possessive
    quantifiers keep Java's matcher iterative on very long runs.
    """
    flat = F.regexp_replace(text, rf"(?U)(?:\\[tn]|[{SPACE_CLASS}])++", " ")
    return F.trim(F.regexp_replace(flat, r"(?U)\[\d+\]", ""))


def words(text: Column) -> Column:
    """Whitespace-separated words as an array, without empty strings."""
    return F.array_remove(F.split(text, rf"(?U)[{SPACE_CLASS}]+"), "")


def urls_in(text: Column) -> Column:
    """Every URL in the text, in order."""
    return F.regexp_extract_all(text, F.lit(URL_PATTERN), F.lit(0))
