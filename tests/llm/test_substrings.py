import hashlib
import random
from collections import Counter

import pytest

from sitewind.llm import parts as P
from sitewind.llm import substrings as S

SCHEMA = "doc_id bigint, text string, part string, row string, kept string"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = [False] * len(d)
        last = 0
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                for k in range(max(i, last), i + length):
                    gone[k] = True
                last = i + length
        spans = []
        for k, g in enumerate(gone):
            if g and (k == 0 or not gone[k - 1]):
                spans.append([k, k + 1])
            elif g:
                spans[-1][1] = k + 1
        found.append((len(d), [tuple(x) for x in spans], bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return found


def texts(length, seed):
    draw = random.Random(seed)
    some = lambda n: "".join(draw.choice("abcdeé ") for _ in range(n))
    passages = [some(draw.randrange(length - 5, 3 * length)) for _ in range(12)]
    found = []
    for _ in range(120):
        parts = []
        for _ in range(draw.randrange(4)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            parts += [some(draw.randrange(length)), draw.choice([p, p[a:], p[:a]])]
        found.append("".join(parts))
    found += [found[3]] * 20 + [None, "", "x" * (length - 1), "y" * length, "z" * (length + 1), "ab" * 3 * length, some(5000)]
    found += [found[-1][:2500] + "!" + found[-1][2501:]]
    return found


@pytest.mark.parametrize(("length", "part_bytes"), [(200, 3000), (200, 1 << 20), (40, 2000), (20, 500), (90, 5000)])
def test_against_plain_python(spark, monkeypatch, length, part_bytes):
    monkeypatch.setattr(P.in_parts, "__defaults__", (part_bytes,))
    monkeypatch.setattr(S, "BUCKET_BYTES", 1000)
    data = texts(length, length + part_bytes)
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(data)], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in S.repeated_strings(docs, length).collect()}
    want = dict(enumerate(brute(data, length)))
    assert got == want
    assert sum(bool(w[1]) for w in want.values()) > 30


@pytest.mark.parametrize("modulus", sorted(S.COVERS))
def test_covers(modulus):
    cover = S.COVERS[modulus]
    assert {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def test_null_ids_and_empty_table(spark):
    same = "q w e r t y " * 40
    docs = spark.createDataFrame([(None, same), (None, same), (1, None)], "doc_id bigint, text string")
    got = S.repeated_strings(docs).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 0] and len(got) == 3
    assert S.repeated_strings(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {
        d.doc_id: (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for d, (n, spans, kept) in zip(docs, brute([d.text for d in docs], 200), strict=True)
    }
    assert {r[0]: tuple(r[1:]) for r in S.op6_suffix_dedup(spark, folder).collect()} == want
