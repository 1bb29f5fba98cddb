import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from sitewind.llm import ctw
from sitewind.llm import parts as P

SCHEMA = "doc_id bigint, text string, part string, row string, score string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, depth=4):
    """Weighted probabilities by plain recursion over dictionaries."""
    learned = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    data = [bytes(depth) + lower(t).encode() + b"\0" for _, t in rows]
    counts = defaultdict(lambda: [0, 0])  # (node, context): zeros, ones
    for d, use in zip(data, learned, strict=True):
        for at in range(depth, len(d) if use else 0):
            for level in range(8):
                node, bit = 1 << level | d[at] >> (8 - level), d[at] >> (7 - level) & 1
                for k in range(depth + 1):
                    counts[node, d[at - k : at]][bit] += 1
    children = defaultdict(list)
    for node, context in counts:
        if context:
            children[node, context[1:]].append((node, context))

    def own(key):
        a, b = counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    @lru_cache(None)
    def log_weighted(key):
        if len(key[1]) == depth:
            return own(key)
        return math.log(0.5) + np.logaddexp(own(key), sum(log_weighted(c) for c in children[key]))

    def one(node, before, k):
        """Probability of a one at the context of the last k bytes."""
        key = node, before[depth - k :]
        if key not in counts:
            return None
        a, b = counts[key]
        here = (b + 0.5) / (a + b + 1)
        below = one(node, before, k + 1) if k < depth else None
        if below is None:
            return here
        w = math.exp(min(0, own(key) + math.log(0.5) - log_weighted(key)))
        return w * here + (1 - w) * below

    words = [[*re.findall(rb"[^\x20\x09-\x0D]+", lower(t).encode()), None] for _, t in rows]
    c = Counter(w for ws, use in zip(words, learned, strict=True) if use for w in ws)
    n, v = sum(c.values()), len(c)
    found = []
    for (i, _), d, ws, use in zip(rows, data, words, learned, strict=True):
        score = 0.0
        for at in range(depth, len(d)):
            for level in range(8):
                node, bit = 1 << level | d[at] >> (8 - level), d[at] >> (7 - level) & 1
                p = one(node, d[at - depth : at], 0)
                p = 0.5 if p is None else p
                score += math.log10(p if bit else 1 - p)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        found.append((i, not use, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return found


def rows():
    draw = random.Random(8)
    words = ["The", "cat", "sAt", "on", "mat", "é", "über", "\n", "\t", "  ", "x1", "🙂"]
    found = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(30)))) for i in range(70)]
    return [*found, (100, None), (101, ""), (None, "the null id"), (None, None), (3, "same id"), (102, "w" * 5000 + " end"), (103, "w" * 5000 + " END")]


def key(r):
    return (-1 if r[0] is None else r[0], *r[1:5], round(r[5], 6), round(r[6], 2))


@pytest.mark.parametrize("part_bytes", [200, 1 << 20])
def test_against_recursion(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(P.in_parts, "__defaults__", (part_bytes,))
    data = rows()
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in data], SCHEMA).repartition(3)
    got = ctw.scored(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    for a, b in zip(sorted(map(key, got)), sorted(map(key, brute(data))), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-5, abs=2e-2)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.5, 100, 12345.5, 1e9])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def test_keys_of_strings():
    grams = np.random.default_rng(1).integers(0, 1 << 40, 5000, dtype=np.uint64)
    grams = np.concatenate([grams, np.arange(256, dtype=np.uint64), np.array([(1 << 40) - 1], np.uint64)])
    assert (ctw.gram_of(ctw.key_of(grams)) == grams).all()
    spaces = np.arange(0, 1 << 24, 4096, dtype=np.uint64) << np.uint64(8) | np.uint64(32)
    assert np.bincount((ctw.key_of(spaces) % np.uint64(256)).astype(int), minlength=256).max() < 50


def test_probabilities_add_up():
    """Over all bytes after a context, seen or not."""
    draw = np.random.default_rng(0)
    seen = np.unique(draw.integers(0, 1 << 40, 300, dtype=np.uint64) & np.uint64(0x0303010FFF))
    counts = draw.integers(1, 9, len(seen)).astype(float)
    tables = []
    for ending in np.unique(seen >> np.uint64(8) & np.uint64(65535)):
        mine = seen >> np.uint64(8) & np.uint64(65535) == ending
        tables.append(ctw._summary(ctw.pa.table({"gram": seen[mine].astype(np.int64), "n": counts[mine].astype(np.int64)})))
    sums = defaultdict(lambda: [0, 0, 0])
    for t in tables:
        for last, node, *rest in zip(*(c.to_pylist() for c in t.columns), strict=True):
            sums[last, node] = [x + y for x, y in zip(sums[last, node], rest, strict=True)]
    top = ctw.Top([(*k, *v) for k, v in sums.items()])
    for context in (int(seen[0] >> np.uint64(8)), 0x03030205, 0x09090909):
        every = np.uint64(context << 8) | np.arange(256, dtype=np.uint64)
        same = seen >> np.uint64(8) & np.uint64(65535) == np.uint64(context & 65535)
        grams = np.union1d(every, seen[same])
        n = np.zeros(len(grams))
        n[np.searchsorted(grams, seen[same])] = counts[same]
        logs = ctw.log10_probabilities(grams, n, top)[np.searchsorted(grams, every)]
        assert (10**logs).sum() == pytest.approx(1)


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "ab")], "doc_id bigint, text string")
    row = ctw.scored(docs).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (2, 0, 0, 0.0)
    assert row.score == pytest.approx(24 * math.log10(0.5))
    assert ctw.scored(docs.limit(0)).count() == 0


def test_query_beats_even_bytes_on_held_out_texts(spark):
    rows = ctw.op3_ctw_score(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.bits_per_byte for r in rows) / len(rows) < 2.5


def test_a_part_sorts_no_occurrences(monkeypatch):
    """Its distinct strings and tokens come from hashing; counts are those of the texts learned from."""
    data = [(i, (t or "").encode()) for i, t in rows() if i is not None] * 3
    table = ctw.pa.table({"doc_id": [i for i, _ in data], "text": ctw.pa.array([t for _, t in data], ctw.pa.binary())})
    want = Counter()
    for i, t in data:
        if not ctw.held_out(i):
            t = bytes(4) + lower(t.decode()).encode() + b"\0"
            want.update(int.from_bytes(t[at - 4 : at + 1]) for at in range(4, len(t)))
    for name in ("unique", "sort", "argsort"):
        monkeypatch.setattr(np, name, None)
    texts = ctw._Texts(table)
    grams, place, of = texts.grams()
    assert len(place) == len(of) == sum(len(t) + 1 for _, t in data) and len(set(grams.tolist())) == len(grams)
    found = zip(*(x.tolist() for x in (ctw.gram_of(grams), texts.learned_counts(grams, place, of)[1])), strict=True)
    assert {g: n for g, n in found if n} == want
    words = texts.words()
    assert texts.learned_counts(*words)[1].sum() == sum(
        len(lower(t.decode()).encode().split()) + 1 for i, t in data if not ctw.held_out(i)
    )
