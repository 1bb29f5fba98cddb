import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitewind.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n string, value string"


def brute(rows, least, top):
    """All pairs and terms, with Python's whole numbers."""
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    found = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        whole = {s: sum(c[t] for t in kept) + 2 * len(kept) for s, c in groups.items()}
        share = {s: {t: 1 + 10**9 * (c[t] + 2) // whole[s] for t in kept} for s, c in groups.items()}
        all_of = sum(whole[s] - 2 * len(kept) for s in groups) + 2 * len(kept)
        q = {t: 1 + 10**9 * (sum(c[t] for c in groups.values()) + 2) // all_of for t in kept}
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s, c in groups.items():
            pairs = [(sum(price(share[s][t], share[o][t]) for t in kept), o) for o in groups if o != s]
            listed = [(price(share[s][t], q[t]), t) for t in kept if c[t] and share[s][t] > q[t]]
            for part, some, most in (("pair", pairs, None), ("term", listed, top)):
                some.sort(key=lambda x: (-x[0], x[1].encode()))
                found |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(some[:most])}
    return found


def rows():
    draw = np.random.default_rng(5)
    words = [f"w{chr(97 + i)}{'é' * (i % 3)}" for i in range(40)] + ["ÄÖ", "straße", "ﬁ", "日本"]
    made = []
    for i in range(160):
        some = draw.choice(words, 1 + int(draw.integers(0, 60)), p=None)
        made.append((" ".join(some) + ("1A-b" if i % 4 else ""), ["en", "de", None][i % 3], f"s{i % 5 % (1 + i % 4)}"))
    made += [(None, "en", "none"), ("", "en", "empty"), ("12 34", "xx", "a"), ("once", "xx", "b"), (None, None, None)]
    made += [("long " * 50_000 + "tail", "en", "s0")] + [made[7]] * 3
    return made


def frame(spark, rows):
    return spark.createDataFrame([(1, *r, "x", "y", "z") for r in rows], SCHEMA)


@pytest.mark.parametrize("block", [3, 50_000])
def test_against_plain_python(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "TEXT_AT_ONCE", 1000)
    got = [tuple(r) for r in divergence.audit(frame(spark, rows()), 10, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows(), 10, 4)


def test_few_rows(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    one = [tuple(r) for r in divergence.audit(frame(spark, [("a b", "en", "s")]), 1).collect()]
    assert set(one) == brute([("a b", "en", "s")], 1, 10)
    two = [(None, "en", "s"), ("x", "en", "t")]
    assert {tuple(r) for r in divergence.audit(frame(spark, two)).collect()} == {
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.integers(0, 30), st.integers(1, 10**12), max_size=20),
    st.dictionaries(st.integers(0, 30), st.integers(1, 10**12), max_size=20),
    st.sampled_from([0, 10**6, 8 * 10**15, 10**17]),
)
def test_merge(a, b, more):
    whole = [sum(x.values()) + 62 + more for x in (a, b)]
    packed = [(np.array(sorted(x), np.int32), np.array([x[k] for k in sorted(x)], np.int64)) for x in (a, b)]
    price = lambda p, q: (p - q) ** 2 // (p + q)
    share = lambda n, w: 1 + 10**9 * (n + 2) // w
    either = set(a) | set(b)
    assert divergence.merged(*packed, *whole) == (
        len(either), sum(price(share(a.get(t, 0), whole[0]), share(b.get(t, 0), whole[1])) for t in either))
