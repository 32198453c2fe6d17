"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from gleanery.llm.simhash import bucket_forest, fingerprint, fingerprint_links, simhash_duplicates
from tests.llm import brute
from tests.llm.conftest import table, words


def plain_fingerprint(text: str | None) -> int:
    """The fingerprint by the definition, unsigned."""
    found = brute.WORD.findall(brute.lower(text or ""))
    runs = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict, radius: int = 2) -> dict:
    """key: smallest reachable key, all pairs compared."""
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(prints)
    for a in keys:
        for b in keys:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_documents(docs, rows):
    prints = {d: plain_fingerprint(t) for d, t in rows}
    want = plain_components(prints)
    got = {r.doc_id: r for r in simhash_duplicates(docs).collect()}
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{prints[d]:016x}", want[d]) for d in prints}
    assert got[17].fingerprint == "0" * 16 and got[18].component_id == got[19].component_id == 17


def test_odd_rows(odd, empty):
    got = sorted(((r.doc_id or 0, r.component_id or 0, r.fingerprint) for r in simhash_duplicates(odd).collect()))
    copy = f"{plain_fingerprint(words(50, 60)):016x}"
    assert [g[:2] for g in got if g[2] == copy] == [(0, 1), (1, 1), (1, 1), (2, 1)]
    assert (0, 0, "0" * 16) in got and len(got) == 6
    assert simhash_duplicates(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "cé", " ", "\n", "\t", "\x1c", "\x85", "word"]), max_size=60), st.sampled_from([1, 7, 1 << 20]))
def test_pieces_do_not_matter(parts, limit):
    text = "".join(parts)
    assert fingerprint(text.encode(), limit=limit) % (1 << 64) == plain_fingerprint(text)


def test_a_very_long_text(spark):
    long = words(70, 400_000)
    got = simhash_duplicates(table(spark, [(1, long), (2, long + " end"), (3, "x" * 3_000_000)])).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535), min_size=1, max_size=90, unique=True), min_size=1, max_size=5), st.integers(0, 2))
def test_buckets(groups, radius):
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    free = np.concatenate([np.array(g, np.uint16) for g in groups])
    member, root = bucket_forest(group, free, radius)
    found = dict(zip(member.tolist(), root.tolist()))
    begin = 0
    for g in groups:
        want = plain_components({begin + i: x for i, x in enumerate(g)}, radius)
        assert {k: found.get(k, k) for k in want} == want
        begin += len(g)


def test_a_full_bucket_is_one_component():
    """All 65,536 fingerprints that agree in six bytes, which is the most there can be."""
    free = np.random.default_rng(0).permutation(1 << 16).astype(np.uint16)
    member, root = bucket_forest(np.zeros(1 << 16, np.int64), free)
    assert len(member) == (1 << 16) - 1 and set(root.tolist()) == {0}


def test_no_link_between_different_fingerprints_is_lost(spark):
    """Random fingerprints, with neighbours at one to four bits, and a chain of steps of two."""
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for p in prints[:200]:
        for bits in (1, 2, 2, 3, 4):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), bits)))
    at = rng.getrandbits(64)
    for step in range(20):
        prints.append(at := at ^ 3 << 3 * step)
    prints = sorted(set(prints))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    classes = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    edges = [(e.a % (1 << 64), e.b % (1 << 64)) for e in fingerprint_links(classes).collect()]
    assert all(a != b for a, b in edges)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {p: find(p) for p in prints} == plain_components({p: p for p in prints})


def test_hot_fingerprints_are_joined_by_broadcast(docs, rows, monkeypatch):
    from gleanery.llm import simhash

    want = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_duplicates(docs).collect()}
    monkeypatch.setattr(simhash, "HOT", 1)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_duplicates(docs).collect()} == want
