import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitewind.llm import shingles
from sitewind.llm.common import staged

SCHEMA = "doc_id bigint, text string, row string, digest string, component string, n string"


def brute_set(text, length=3):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + length]) for i in range(max(len(words) - length + 1, 1))} if words else set()


def brute(rows, percent=90):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def changed(draw, words, n):
    words = list(words)
    for _ in range(n):
        at = draw.randrange(len(words) + 1)
        kind = draw.random()
        if kind < 0.4 and words:
            words[at % len(words)] = f"new{draw.random()}"
        elif kind < 0.7:
            words.insert(at, draw.choice(words or ["x"]))
        elif words:
            del words[at % len(words)]
    return words


def rows(seed, size):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    made = []
    passage = draw.choices(vocabulary, k=40)
    for family in range(size):
        base = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 8, 12, 30, 80, 200]))
        if family % 4 == 0:
            base = passage + base + passage
        for _ in range(draw.choice([1, 1, 2, 5, 25])):
            made.append(" ".join(changed(draw, base, draw.choice([0, 0, 1, 1, 2, 4, 8]))))
    made += [None, "", " \n", "One", "one", "ONE two", "one  two", "é É", "é é", "one two three", "Ähm ähm x y" * 9]
    draw.shuffle(made)
    numbered = [(i * 3 % 1009, t) for i, t in enumerate(made)]
    return numbered + [(None, made[0]), (None, None), numbered[5], (numbered[5][0], "another text of this id")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("seed", "tokens", "part"), [(1, 1 << 16, 8 << 20), (2, 300, 2000), (3, 2000, 500)])
def test_against_all_pairs(spark, monkeypatch, seed, tokens, part):
    monkeypatch.setattr(shingles, "GROUP_TOKENS", tokens)
    monkeypatch.setattr(shingles, "PART_BYTES", part)
    some = rows(seed, 40)
    assert sorted(map(tuple, shingles.joined(frame(spark, some)).collect()), key=str) == brute(some)


def test_one_family_whose_members_are_linked_through_few(spark, monkeypatch):
    monkeypatch.setattr(shingles, "GROUP_TOKENS", 1500)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    some = [(i, " ".join(changed(draw, base, 1 + i % 6))) for i in range(150)]
    assert sorted(map(tuple, shingles.joined(frame(spark, some)).collect()), key=str) == brute(some)


def test_sets_meet_groups_of_about_their_size_only(spark, monkeypatch):
    """However many other groups there are: what a set is sent to must not grow with them."""
    monkeypatch.setattr(shingles, "GROUP_TOKENS", 300)
    tables = {}

    def kept(df, name, by=None):
        tables[name] = staged(df, name, by)
        return tables[name]

    monkeypatch.setattr(shingles, "staged", kept)
    some = rows(4, 40)
    assert sorted(map(tuple, shingles.joined(frame(spark, some)).collect()), key=str) == brute(some)
    members = [r.asDict() for r in tables["groups"].collect()]
    in_component = Counter(r["component"] for r in members)
    sizes = {}
    for r in members:
        if in_component[r["component"]] == 1:
            sizes.setdefault(r["group"], []).append(r["n"])
    assert any(len(n) > 1 for n in sizes.values())
    assert all(max(n) <= min(n) * shingles.SIZE_STEP + 1 for n in sizes.values())


def test_steps_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString(" ").split() if "/shuffle_" in f}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), files()
    found = shingles.joined(frame(spark, rows(5, 5)))
    end = time.time() + 30
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(name, None) == setting
    assert found.count() == len(rows(5, 5))


def test_given_documents_and_an_empty_table(spark):
    some = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = shingles.op11_ngram_jaccard(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(some)
    assert shingles.joined(frame(spark, [(1, "x")]).limit(0)).count() == 0
    assert [tuple(r) for r in shingles.joined(frame(spark, [(1, None)])).collect()] == [(1, 0, 1)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 1 << 30), st.sampled_from([80, 90]))
def test_partners_meet(common, left, right, seed, percent):
    """Of any two linked sets, those that the larger one may ask with miss few of the smaller one's."""
    draw = np.random.default_rng(seed)
    names = np.unique(draw.integers(0, 1 << 62, common + left + right))
    draw.shuffle(names)
    a, b = np.sort(names[: common + left]), np.sort(np.concatenate([names[:common], names[common + left :]]))
    if len(a) < len(b):
        a, b = b, a
    both = len(np.intersect1d(a, b))
    if 100 * both < percent * (len(a) + len(b) - both):
        return
    asked = a[: shingles.asked_length(len(a), percent)]
    kept = b[: shingles.kept_length(len(b), percent)]
    assert shingles.least_overlap(len(a), percent) <= len(b)
    assert len(np.setdiff1d(asked, kept)) <= shingles.missing(len(a), percent) < len(asked)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbÉ \t\n\x0b\x1c\x85 "), max_size=25), max_size=5))
def test_names(texts):
    found = shingles.names(pa.array(texts, pa.string()))
    sets = [brute_set(t) for t in texts]
    assert [len(f) for f in found] == [len(s) for s in sets]
    for f, s in zip(found, sets):
        for g, t in zip(found, sets):
            assert len(np.intersect1d(f, g)) == len(s & t)
