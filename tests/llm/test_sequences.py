import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitewind.llm import sequences
from sitewind.llm.common import shared_path

SCHEMA = "doc_id bigint, text string, file string, part string, start string"


def rows():
    draw = random.Random(9)
    words = ["hello", "World's", "\n", "  ", "naïve", "42", "<|endoftext|>", "\t ", "🙂🙂", "x" * 50, "!!"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(150)]
    found = [(i * 3 % 151, t) for i, t in enumerate(texts)]
    return found + [(200, None), (201, ""), (None, "null id"), (None, None), (7, "same id"), (7, "same id"), (202, "long text " * 4000)]


def test_round_trip(spark):
    folder = shared_path(spark, "sequences")
    docs = spark.createDataFrame([(*r, "f", "p", "s") for r in rows()], SCHEMA)
    manifest = sequences.write_sequences(docs, folder, sequences.tokenizer_file(), length=16, batch=8)
    got = sequences.read_documents(manifest, folder, length=16, batch=8).collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = sorted(
        (-1 if i is None else i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
        for i, t in rows()
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in got) == want
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.doc_id if r.doc_id is not None else -1) >= last
        assert len(r.ids) == 4 * r.n_tokens
        at, last = at + r.n_tokens, r.doc_id if r.doc_id is not None else -1

    parts = {}
    for r in sequences.read_sequences(spark, manifest, folder, length=16).collect():
        assert len(r.ids) == len(r.mask) == 16
        parts.setdefault(r.file, []).append((r.sequence, [i for i, m in zip(r.ids, r.mask, strict=True) if m]))
    laid = [i for f in sorted(parts) for _, ids in sorted(parts[f]) for i in ids]
    whole = b"".join(bytes(r.ids) for r in sorted(got, key=lambda r: r.start))
    assert laid == np.frombuffer(whole, "<u4").tolist()
    assert all(sum(len(ids) < 16 for _, ids in file) <= 1 for file in parts.values())


def test_a_sequence_is_a_view_of_the_file(spark):
    folder = shared_path(spark, "sequences")
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id bigint, text string")
    row = sequences.write_sequences(docs, folder, sequences.tokenizer_file(), length=4, batch=64).first()
    before = sequences.pa.total_allocated_bytes()
    ids = sequences.tokens(f"{folder}/{row.file}", 0, 3, 4, 64)
    assert not ids.flags.owndata and ids.dtype == np.uint16 and len(ids) == 3
    assert sequences.pa.total_allocated_bytes() == before


def test_empty_table(spark):
    folder = shared_path(spark, "sequences")
    manifest = sequences.write_sequences(spark.createDataFrame([], SCHEMA), folder, sequences.tokenizer_file())
    assert sequences.read_documents(manifest, folder).count() == 0
    assert sequences.read_sequences(spark, manifest, folder).count() == 0


def test_query(spark):
    got = sequences.op2_token_files(spark, "/root/testdata/sf0.001").collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    start, want = 0, []
    for d in docs:
        ids = np.array([*library.encode(d.text, add_special_tokens=False).ids, 2], "<u4")
        want.append((d.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got)) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(
    st.lists(st.sampled_from([*"ab .,1\n\t é日'😀\x1c<|>", "<|endoftext|>", " next"]), max_size=20).map("".join),
    min_size=1, max_size=6,
))
def test_ids_are_those_of_the_library(texts):
    encoder = sequences._encoder(sequences.tokenizer_file())
    found = encoder.texts(pa.array(texts, pa.string()))
    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert [f.tolist() for f in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_columns_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "f", "p", "s")], SCHEMA)
    manifest = sequences.write_sequences(docs.limit(0), shared_path(spark, "empty"), sequences.tokenizer_file())
    assert manifest.count() == 0 and sequences.read_documents(manifest, shared_path(spark, "empty")).count() == 0
