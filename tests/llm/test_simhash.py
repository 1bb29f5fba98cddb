import random

import numpy as np
import pytest
import xxhash

from sitewind.llm import golay, simhash
from sitewind.llm.components import _large_star, _small_star, components

SCHEMA = "doc_id bigint, text string, print string, component string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(prints):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    prints = sorted(parent)
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_every_pair_within_two_bits_meets_at_the_home_of_each():
    draw = np.random.default_rng(7)
    prints = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    one = np.uint64(1) << draw.integers(0, 64, 400, dtype=np.uint64)
    two = np.uint64(1) << draw.integers(0, 64, 400, dtype=np.uint64)
    rows, anchors = golay.meeting_places(prints)
    met = set(zip(rows.tolist(), anchors.tolist(), strict=True))
    assert len(met) == len(rows)
    for other in (prints, prints ^ one, prints ^ one ^ two):
        for row, home in enumerate(golay.homes(other).tolist()):
            assert (row, home) in met


def test_components_of_chains_and_stars(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    links += [(b, a) for a, b in links]
    draw.shuffle(links)
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_against_all_pairs(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(draw.choice(words) for _ in range(draw.choice([1, 2, 3, 4, 8, 60])))))
    for i in range(120, 200):  # near copies: longer texts with one word changed
        base = rows[draw.randrange(120)][1].split()
        base = (base * 40)[:300]
        base[draw.randrange(len(base))] = draw.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (None, "Same TEXT here now"), (303, "same text HERE now"),
             (304, "é ß"), (None, None), (5, rows[5][1]), (305, "long " * 30000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    prints = {brute_print(t) for _, t in rows}
    root = brute_components(prints)
    least = {}
    for i, t in rows:
        if i is not None:
            c = root[brute_print(t)]
            least[c] = min(least.get(c, i), i)
    want = sorted((-1 if i is None else i, brute_print(t), least.get(root[brute_print(t)])) for i, t in rows)
    got = sorted((-1 if r[0] is None else r[0], r[1] % (1 << 64), r[2]) for r in found)
    assert got == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("text", ["a b c", "x y", "x", "a a a a a a"])
def test_print_of_short_texts(text):
    assert simhash._simhash(text, 3) % (1 << 64) == brute_print(text)


def test_what_grows_with_the_fingerprints_is_not_broadcast(spark, monkeypatch):
    """Places are many times the fingerprints they are of, and files of ids far smaller than the ids."""
    prints = spark.range(2000).selectExpr("xxhash64(id) as print")
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan

    docs = spark.createDataFrame([(i, f"w{i % 7} x y z", "", "") for i in range(50)], SCHEMA)
    plan = simhash.near_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan

    links = spark.range(1, 10).selectExpr("id + 1 as high", "id as low")
    for star in (_large_star, _small_star):
        assert "BroadcastHashJoin" in star(links, False)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in star(links, True)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("sitewind.llm.components.MANY", 1)
    assert sorted(map(tuple, components(links).collect())) == [(i, 1) for i in range(1, 11)]
