import base64
import random

import public_tokenizers as tokenizers
import pytest
import tiktoken

from quillgrid.llm.bpe import STRETCH, Codec, bpe_round_trip, product

from .common import AWKWARD, docs_frame

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    raw = open(PATH, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return Codec(raw, tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_is_its_own_encoding(both):
    """What the join's proof needs."""
    codec, _ = both
    assert all(codec.leaf(t) == [i] for t, i in codec.ranks.items())


def test_same_as_tiktoken(both):
    codec, other = both
    rng = random.Random(5)
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400))) for alphabet in ("ab", "the ing", " \n\t", "éèüßñ ", "日本語 ", "0123456789", "abcdefghij", "-=*#", "Ωж́a") for _ in range(60)]
    samples += [x for x in AWKWARD if x] + ["a" * 5000, " " * 3000 + "x", "\n" * 2000, "ab" * 3000, "<|endoftext|>"]
    for text in samples:
        ids = codec.encode(text)
        assert ids == other.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_join_is_the_whole_encoding(both):
    codec, _ = both
    rng = random.Random(6)
    for _ in range(2000):
        word = bytes(rng.choice(b"theinger an") for _ in range(rng.randint(2, 60)))
        cut = rng.randint(0, len(word))
        a, b = codec.leaf(word[:cut]) if cut else [], codec.leaf(word[cut:]) if cut < len(word) else []
        assert codec.join(a, b) == codec.leaf(word)
    seen = []
    items = list(range(5 * STRETCH + 3))
    assert product(items, lambda x: seen.append(len(x)) or list(x), list.__add__) == items and max(seen) <= STRETCH < sum(seen)
    assert product([], list, list.__add__) == []


def test_round_trip_operator(spark):
    rows = docs_frame(spark, [*enumerate(AWKWARD), (None, "x"), (None, "x")]).selectExpr("*", "'clash' AS ids")
    got = bpe_round_trip(rows, PATH, tokenizers.PATTERN).collect()
    assert len(got) == len(AWKWARD) + 2
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in got)
    assert bpe_round_trip(docs_frame(spark, []), PATH, tokenizers.PATTERN).count() == 0
