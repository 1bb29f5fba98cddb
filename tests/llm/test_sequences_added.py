import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sitewind.llm import sequences, wordcodes
from sitewind.llm.common import shared_path


def test_added_tokens_have_their_own_ids(spark):
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, mark * 3, f"\n {mark}\n  {mark}x", f"{mark[:-1]} {mark}", mark[1:], "plain text", "", None]
    folder = shared_path(spark, "sequences")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    manifest = sequences.write_sequences(docs, folder, sequences.tokenizer_file(), length=16, batch=8)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in sequences.read_documents(manifest, folder, 16, 8).collect()}
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert got == {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert got[0] == [64, 220, 50256, 275, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\x1c\x85\xa0　a-é"), max_size=4), max_size=6))
def test_parts_that_stand_alone(parts):
    """Found for all parts of a batch together."""
    alone = [not p or " " in p or p[0].isspace() or p[-1].isspace() for p in parts]
    assert wordcodes._whole(parts) == [at for at, one in enumerate(alone) if one]
