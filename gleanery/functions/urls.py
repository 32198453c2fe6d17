"""URL expressions: storage key, host, link resolution. No Python in the path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: characters a storage key may not hold; each becomes "_".
KEY_FORBIDDEN = '<>:"/\\|?*'

# scheme with slashes, userinfo, host, port of an http(s) URL
_AUTHORITY = r"^(?i)(https?://)((?:[^/?#@\\]*@)?)(\[[^\]]*\]|[^/?#:\\]+)(:\d*)?"

# What the URL standard percent-encodes in a path, and after it.
_PATH_UNSAFE = r"""[^\x21-\x7e]|["<>`{}]"""
_SUFFIX_UNSAFE = r"""[^\x21-\x7e]|["<>]"""

# A rooted href that resolves by mere concatenation: no second slash, no backslash, no
# dot segment, nothing to encode.
_PLAIN = r"""^/(?![/.])(?:[^\x00-\x20\x7f-\x{10ffff}"<>`{}\\/?#]++|/(?!\.))*+(?:[?#][^\x00-\x20\x7f-\x{10ffff}"<>`{}\\]*+)?$"""


def url_key(url: Column) -> Column:
    """Storage key of a page. http/https twins and ``a/b`` vs ``a_b`` share a key."""
    bare = F.regexp_replace(url, "^https?://", "")
    return F.translate(bare, KEY_FORBIDDEN, "_" * len(KEY_FORBIDDEN))


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _AUTHORITY, group)


def url_host(url: Column) -> Column:
    """Lower-case hostname without port; NULL when the URL has none."""
    return F.nullif(F.lower(_part(url, 3)), F.lit(""))


def _origin(url: Column) -> Column:
    """``scheme://[user@]host[:port]``, lower-case, default port dropped; "" if none."""
    place = F.lower(F.concat(_part(url, 3), _part(url, 4)))
    scheme = F.lower(_part(url, 1))
    shown = F.regexp_replace(F.concat(scheme, _part(url, 2), place), "^(http://.*):80$|^(https://.*):443$|^(.*):$", "$1$2$3")
    return F.when(scheme != "", shown).otherwise("")


def _escape(text: Column, unsafe: str) -> Column:
    """Percent-encode the characters matching the class ``unsafe`` as UTF-8."""
    one = lambda c: F.when(c.rlike(unsafe), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c)
    spelled = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), "")
    return F.when(text.rlike(unsafe), spelled).otherwise(text)


def _fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    step = lambda done, seg: (
        F.when(seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg)))
    )
    segments = F.split(F.substring(path, 2, 2**31 - 1), "/")
    kept = F.aggregate(segments, F.expr("cast(array() as array<string>)"), step)
    tail = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(
        path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    ).otherwise(path)


def with_target(links: DataFrame, href: str = "href", base: str = "url") -> DataFrame:
    """Links that can be followed, with their ``target``.

    Only hrefs starting with ``/`` are resolved (``//host/x`` takes the base scheme),
    with the normalisation the URL standard gives them; hrefs starting with ``http`` pass
    untouched; every other form is dropped. Each step is a column of its own, and links
    without a target leave by an ``explode`` of none: a filter on the target would be
    pushed below these steps and have every regular expression run again.
    """
    raw = F.col(href)
    located = links.withColumn("_origin", _origin(F.col(base)))
    rooted = F.translate(F.regexp_replace(F.rtrim(raw), "[\t\n\r]", ""), "\\", "/")
    other_host = F.concat(F.regexp_extract("_origin", "^https?:", 0), rooted)
    kind = F.when(raw.rlike(_PLAIN), "plain").when(raw.startswith("//"), "host").when(raw.startswith("/"), "rooted")
    parsed = located.withColumn("_kind", F.when(F.col("_origin") != "", kind)).withColumn(
        "_full",
        F.when(F.col("_kind") == "host", F.concat(_origin(other_host), F.regexp_replace(other_host, _AUTHORITY, "")))
        .when(F.col("_kind") == "rooted", F.concat("_origin", rooted)),
    )
    at = F.length(F.regexp_extract("_full", _AUTHORITY, 0))
    split = parsed.withColumn("_rest", F.substr("_full", at + 1)).withColumn("_base", F.substr("_full", F.lit(1), at))
    path = F.regexp_extract("_rest", r"^[^?#]*", 0)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    suffix = F.regexp_extract("_rest", r"(?s)[?#].*$", 0)
    normalized = F.concat("_base", _escape(_fold_dots(path), _PATH_UNSAFE), _escape(suffix, _SUFFIX_UNSAFE))
    target = (
        F.when(F.col("_kind") == "plain", F.concat("_origin", raw))
        .when(F.col("_kind").isNotNull() & (F.col("_base") != ""), normalized)
        .when(raw.startswith("http"), raw)
    )
    return split.select(*links.columns, F.explode(F.array_compact(F.array(target))).alias("target"))
