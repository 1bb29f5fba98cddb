import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sitewind.llm import bpe, pieces

SCHEMA = "doc_id bigint, text string, ids string, decoded string, word string"


@pytest.fixture(scope="module")
def encoding():
    lines = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(5)
    kinds = ["der", "Straße", "don't", "x's", "'", "12345", "---", "\n", "  ", "\t", " ", " ", " ", "日本", "é́", "🙂", "\x1c", "\u0085", "AKIA"]
    found = ["", " ", "  ", "   a", "a   ", "a \n b", "a\n \nb", "x" * 3000, "ab" * 700 + " end", " 's", "'S I'll"]
    found += ["".join(draw.choice(kinds) + draw.choice(["", " "]) for _ in range(draw.randrange(40))) for _ in range(300)]
    return found


def test_against_a_library(spark, encoding):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts())] + [(None, None, None, None, None), (3, "a b", "", "", "")]
    coded = bpe.encoded(spark.createDataFrame(rows, SCHEMA).repartition(3), bpe.rank_file())
    got = coded.select("doc_id", "text", "word", "ids", "decoded", *bpe.digests(coded)).collect()
    assert len(got) == len(rows)
    for doc_id, text, word, ids, decoded, n, ids_sha, decoded_sha in got:
        want = encoding.encode_ordinary(text or "")
        assert list(ids) == want
        assert bytes(decoded) == (text or "").encode()
        assert n == len(want)
        assert ids_sha == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert decoded_sha == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encoded(spark.createDataFrame([], SCHEMA), bpe.rank_file()).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n\t \x1ca'sZ1-é"), max_size=14))
def test_a_cut_text_has_the_matches_of_the_whole(text):
    first, rest = pieces.cut(text)
    assert "".join(first) + "".join(" " + r for r in rest) == text
    parts = first + [" " + r for r in rest]
    assert [m for p in parts for m in pieces.matches(p)] == pieces.matches(text)


def test_forgetting_changes_nothing(encoding, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    memory = pieces.Remembered(bpe.Codec(bpe.rank_file()).codes, b"")
    for text in texts()[:60]:
        ids = b"".join(memory.codes([text])[0])
        assert list(memoryview(ids).cast("i")) == encoding.encode_ordinary(text)


def test_the_ids_of_whole_texts_are_decoded(encoding, monkeypatch):
    """All of them, in order, also where a text goes on in the next query."""
    codec = bpe.Codec(bpe.rank_file())
    given = [np.array(encoding.encode_ordinary(t), np.int32) for t in texts()[:80]]
    given += [given[-1][::-1], np.zeros(0, np.int32)]
    want = [encoding.decode_bytes(ids.tolist()) for ids in given]
    for at_once in (7, 400_000):
        monkeypatch.setattr(bpe, "IDS_AT_ONCE", at_once)
        assert codec.decode(np.concatenate(given), np.cumsum([len(ids) for ids in given])) == want
    assert codec.decode(np.zeros(0, np.int32), np.zeros(2, np.int64)) == [b"", b""]


def test_a_match_that_was_a_part_is_known(encoding):
    sent = []
    codec = bpe.Codec(bpe.rank_file())
    memory = pieces.Remembered(lambda words: sent.extend(words) or codec.codes(words), b"")
    for text in ["Zyxwv qponm x", "Zyxwv, qponm; x-"]:
        assert list(memoryview(b"".join(memory.codes([text])[0])).cast("i")) == encoding.encode_ordinary(text)
    assert len(sent) == len(set(sent)) and b"Zyxwv" in sent and b" qponm" in sent
