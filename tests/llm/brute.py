"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fold(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def base_scores(docs: dict[int, str | None]):
    """doc_id: (n_tokens, n_known, train_tokens, base_score)."""
    tokens = {d: [*WORD.findall(lower(t or "")), None] for d, t in docs.items()}
    counts = Counter(w for d, ws in tokens.items() if fold(d, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for d, ws in tokens.items()
    }


def quality(text: str | None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, copies, len(repeated), failed


def near_components(docs: dict[int, str | None], k: int, threshold: int = 80):
    """doc_id: (n_shingles, component_id)."""
    sets = {}
    for d, t in docs.items():
        w = WORD.findall(lower(t or ""))
        n = min(k, len(w))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def passages(docs: dict[int, str | None], items: list[tuple]):
    """doc_id: (n_words, n_hit, sorted items)."""
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(lower(text or ""))
        n = min(10, len(w))
        if n and item is not None:
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(str(item))
    out = {}
    for d, t in docs.items():
        w = ITEM_WORD.findall(lower(t or ""))
        hit, got = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    got |= found
                    hit.update(range(i, i + n))
        out[d] = len(w), len(hit), sorted(got)
    return out


def repeats(docs: dict[int, str | None], length: int = 50):
    """doc_id: (n_bytes, n_removed, n_spans, kept)."""
    first, out = {}, {}
    for d in sorted(docs):
        b = (docs[d] or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first.setdefault(b[i : i + length], d) < d:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out[d] = len(b), sum(covered), len([x for x in bytes(covered).split(b"\0") if x]), kept
    return out


ASSIGN = re.compile(
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(text: str | None) -> list[tuple[int, int, str]]:
    text, found = text or "", []
    found += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, e, k) for s, _, e, k in sorted(found)]
