"""Texts of millions of tokens in the tokenizer."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import tiktoken

from gleanery.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_a_text_of_millions_of_tokens_comes_back():
    codec = bpe.codec_of(RANKS, public_tokenizers.PATTERN)
    text = "one two, three\n" * 1_200_000
    ids, borders = codec.encode(["before", text, "", "after"])
    assert len(ids) > 4_500_000
    assert codec.decode(ids, borders) == [b"before", text.encode(), b"", b"after"]


def test_slices_keep_order_and_documents():
    codec = bpe.codec_of(RANKS, public_tokenizers.PATTERN)
    tokens = {rank: token for token, rank in codec.ranks.items()}
    rng = np.random.default_rng(3)
    ids = rng.choice(np.array(list(tokens), np.int32), 3 * (1 << 18) + 17)
    borders = np.array([0, 5, (1 << 18) - 1, (1 << 18), (1 << 18), 2 * (1 << 18) + 9, len(ids)])
    want = [b"".join(map(tokens.__getitem__, x.tolist())) for x in np.split(ids, borders[:-1])]
    assert codec.decode(ids, borders) == want


def test_many_long_pieces_fit_the_queries():
    """Distinct pieces as long as the query takes: their rounds would not fit its memory at once."""
    rng = random.Random(4)
    pieces = ["".join(rng.choices("abcdefgh", k=bpe.QUERY_BYTES)) for _ in range(6000)]
    text = "1".join(pieces + ["é語" * 12 + "".join(rng.choices("abcé", k=9)) for _ in range(2000)])
    known = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    codec = bpe.codec_of(RANKS, public_tokenizers.PATTERN)
    ids, _ = codec.encode(["", text, "a"])
    assert ids.tolist() == known.encode_ordinary(text) + known.encode_ordinary("a")
    assert codec.decode(*codec.encode([""])) == [b""]
