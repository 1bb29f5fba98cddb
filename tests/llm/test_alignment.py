import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitewind.llm import alignment, sequences, wordcodes

SCHEMA = "doc_id bigint, text string, part string, pairs string, groups string, _text string"


def libraries():
    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute_tokens(text, one, two):
    """(ids, bytes) of both sides, by the libraries; none where the bytes differ."""
    if not text:
        return [], []
    decode = {c: bytes([b]) for b, c in sequences.byte_characters().items()}
    whole = (" " + text).encode()
    a = [(i, b"".join(decode[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in two.encode(text):
        piece = two.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
    same = all(b"".join(x for _, x in side) == whole for side in (a, b))
    return (a, b) if same else ([], [])


def spans(side):
    found, at = [], 0
    for i, spelled in side:
        found.append((i, at, at + len(spelled)))
        at += len(spelled)
    return found


def brute(rows):
    one, two = libraries()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, brute_tokens(text, one, two))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 300 else slow_links(a, b)
        counts.update(set(links))
        ends = {x[2] for x in a} & {y[2] for y in b}
        groups, begin = [], 0
        for end in sorted(ends):
            groups.append("|".join(",".join(str(x[0]) for x in side if begin <= x[1] < end) for side in (a, b)) if len(a) < 300 else None)
            begin = end
        docs.append((doc_id, len(a), len(b), groups, links))
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    found = []
    for doc_id, n_a, n_b, groups, links in docs:
        found.append((
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[0]] for x in links), sum(counts[x] for x in links),
            None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", ))
    return found


def slow_links(a, b):
    found, j = [], 0
    for x in a:
        while b[j][2] <= x[1]:
            j += 1
        k = j
        while k < len(b) and b[k][1] < x[2]:
            found.append((x[0], b[k][0]))
            k += 1
    return found


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "Hello, world! It's fine.", "line\nline\n\n next  \t x y z",
    "▁odd", "x ▁ y", "<|endoftext|> and <s> </s> <unk> <0x0A>", "日本語のテキスト です 😀😀 é ﬁ ­",
    "\x00 \x1c x\x85 y", "ACGT" * 500, "tab\tend \n", "word " * 700, "naïve café 12345 67.89 " * 40, "x\n y", "\n", "\n x",
    " leading and trailing ", "y 　 z", "\r\n windows \r\n lines",
]


@pytest.mark.parametrize("words", [7, 600_000])
def test_against_the_libraries(spark, monkeypatch, words):
    monkeypatch.setattr(alignment, "WORDS_AT_ONCE", words)
    monkeypatch.setattr(alignment, "TEXT_AT_ONCE", 2000)
    monkeypatch.setattr(alignment, "PART_BYTES", 3000)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, "  "), (3, "other words here")]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "t") for r in rows], SCHEMA).repartition(2)
    got = sorted(map(tuple, alignment.aligned(docs, alignment.tokenizer_file(), alignment.piece_model()).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert all(w[7] in (None, g[7]) for g, w in zip(got, want, strict=True))
    whole = {(r.doc_id, r.text): r for r in alignment.groups(docs, alignment.tokenizer_file(), alignment.piece_model()).collect()}
    assert len(whole) == len(set(rows)) and set(docs.columns) == set(whole[0, None].asDict()) | {"_text"}
    digests = {(g[0], g[7]) for g in got}
    assert {(k[0], hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for k, r in whole.items()} == digests


def test_given_documents_and_an_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, alignment.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()))
    want = sorted(brute(rows))
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert all(w[7] in (None, g[7]) for g, w in zip(got, want, strict=True))
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.aligned(empty, alignment.tokenizer_file(), alignment.piece_model()).count() == 0


SIDES = None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab .,1\n\t é日▁'😀́\x1c")), max_size=30), min_size=1, max_size=6))
def test_ids_are_those_of_the_libraries(texts):
    global SIDES
    SIDES = SIDES or (alignment.byte_level(alignment.tokenizer_file())[1], alignment.pieces(alignment.piece_model()))
    import pyarrow as pa

    memory = wordcodes.Memory(list(SIDES))
    places, ends = memory.places(pa.array(texts))
    one, two = libraries()
    for k, text in enumerate(texts):
        mine = places[ends[k - 1] if k else 0 : ends[k]]
        assert wordcodes.gathered(memory.coded[0], mine)[0].tolist() == one.encode(" " + text, add_special_tokens=False).ids
        if "▁" not in text and text:
            assert wordcodes.gathered(memory.coded[1], mine)[0].tolist() == two.encode(text)
        a, _ = brute_tokens(text, one, two)
        assert bool(a) == bool(text and all(c.exact[mine].all() for c in memory.coded))
