import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from sitewind.llm import bpe


def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.rank_file())


def words():
    draw = random.Random(2)
    some = lambda letters, n: "".join(draw.choices(letters, k=n))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [some("ACGT", 6000), "x" * 100_001, some("0123456789", 2000), " " * 50_000, some(letters, 600),
            some("éß日本", 1000), "=-" * 9000, some("etaoin", 255), some("etaoin", 256), "the" * 300]


def test_long_words_against_a_library(codec):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = encoding(ranks)
    given = words()
    for word, ids in zip(given, codec.encode_words([w.encode() for w in given]), strict=True):
        assert ids.tolist() == library.encode_ordinary(word), word[:20]


def test_rounds_by_any_order_of_ranks(monkeypatch):
    """Made-up vocabularies, in which a longer token often comes before its parts."""
    monkeypatch.setattr(bpe, "LONG", 1)
    draw = random.Random(3)
    for _ in range(10):
        tokens = {"".join(draw.choices("abc", k=draw.randrange(2, 6))).encode() for _ in range(60)}
        order = [bytes([b]) for b in range(256)] + draw.sample(sorted(tokens), len(tokens))
        file = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(order))
        library, codec = encoding({t: i for i, t in enumerate(order)}), bpe.Codec(file)
        given = ["".join(draw.choices("abc", k=draw.randrange(1, 80))) for _ in range(40)] + ["a" * 61, "abc" * 20]
        assert [i.tolist() for i in codec.encode_words([w.encode() for w in given])] == [library.encode_ordinary(w) for w in given]
