"""Byte-level BPE of long words and odd rank files against the library; memory of what is remembered."""

import base64
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from larkspur.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.id_of, special_tokens={})


def same(encoder, library, text):
    ((ids, decoded),) = encoder.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, disallowed_special=())
    assert decoded == text.encode()


def long_words():
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield from ("".join(rng.choices(letters, k=n)) for n in (63, 64, 65, 97, 300, 3000))
    yield from ("".join(rng.choices(some, k=700)) for some in ("ab", "etaoinshr", "aé", "the") for _ in range(4))
    yield from ("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300)) for _ in range(4))
    yield from ("a" * 5001, "ab" * 2000, "abc" * 1500, "漢字かな" * 300, "ก" * 400, "!" * 999, "=" * 900 + "-" * 777, " " * 3000, "\n" * 500)


def test_long_words_equal_the_library(ranks, library):
    assert ranks.ascending
    encoder = ranks.encoder(public_tokenizers.PATTERN)
    for text in long_words():
        same(encoder, library, text)


def test_time_of_a_long_word_grows_with_its_length(ranks, library):
    encoder, rng = ranks.encoder(public_tokenizers.PATTERN), random.Random(2)
    took = []
    for n in (20_000, 160_000):
        text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
        began = time.perf_counter()
        same(encoder, library, text)
        took.append(time.perf_counter() - began)
    assert took[1] < 20 * took[0]


def test_what_is_remembered_is_bounded_in_bytes(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 50_000)
    encoder, rng = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(20):
        encoder.encode([" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(200))])
        assert encoder.size <= 50_000 + 200 * 300 and len(encoder.older) < 1000


def test_rank_file_whose_merges_do_not_ascend():
    """A token of lower rank than its part is reachable by several pairs; words are then contracted as a whole."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab", b"cab", b"abcabc"]
    made = bpe.Ranks(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    assert not made.ascending
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=made.id_of, special_tokens={})
    rng = random.Random(4)
    for n in (3, 6, 30, 200):
        same(made.encoder(public_tokenizers.PATTERN), library, "".join(rng.choices("abc", k=n)))
