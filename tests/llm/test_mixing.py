import random

import numpy as np
import pytest

from sitewind.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, lang string, topic string, kept string, weight string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_nulls_empty_texts_and_an_empty_table(spark):
    rows = [(i, "some plain words " * (1 + i % 5), "a" if i % 3 else "b", "en") for i in range(30)]
    rows += [(None, None, None, None), (40, "", "z", "en"), (1, rows[1][1], "a", "en")]
    docs = frame(spark, rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.probability <= 1 for r in got)
    assert {r.probability for r in got if not r.text} == {1.0} and all(r.kept for r in got if not r.text)
    assert len({r.kept for r in got if r.doc_id == 1}) == 1
    assert {r.weight for r in got} == {"z"} and {r.topic for r in got} == {"prose"}
    stay = mixing.sampled(docs)
    assert stay.columns == docs.columns
    assert sorted(map(str, stay.collect())) == sorted(
        str(r) for r, m in zip(docs.collect(), mixing.mixed(docs).collect(), strict=True) if m.kept)
    assert mixing.mixed(docs.limit(0)).count() == mixing.sampled(docs.limit(0)).count() == 0


def shares(rows, margin, weight):
    found = {}
    for r in rows:
        found[r[margin]] = found.get(r[margin], 0) + weight(r)
    total = sum(found.values())
    return {value: x / total for value, x in found.items()}


def test_tokens_that_stay_have_the_targets(spark):
    draw = random.Random(5)
    kinds = ["", " license", " a@b.org", " 2020", " <p>"]
    rows = []
    for i in range(6000):
        lang = draw.choices(["en", "de", "fr"], [8, 2, 1])[0]
        source = draw.choices(["x", "y", "z", None], [9, 3, 1, 1])[0]
        rows.append((i, "word " * draw.randrange(1, 30) + draw.choices(kinds, [20, 2, 1, 2, 1])[0], source, lang))
    got = mixing.mixed(frame(spark, rows)).collect()
    expected = [r for r in got if r.n_tokens]
    for margin in mixing.MARGINS:
        wanted = shares(expected, margin, lambda r: r.n_tokens)
        tempered = {v: x**mixing.TEMPER for v, x in wanted.items()}
        total = sum(tempered.values())
        reached = shares(expected, margin, lambda r: r.n_tokens * r.probability)
        sampled = shares([r for r in expected if r.kept], margin, lambda r: r.n_tokens)
        for value, target in tempered.items():
            assert reached[value] == pytest.approx(target / total, rel=1e-6)
            assert sampled[value] == pytest.approx(target / total, rel=0.25, abs=0.01)
    kept = sum(r.n_tokens * r.probability for r in expected) / sum(r.n_tokens for r in expected)
    assert kept == pytest.approx(mixing.FRACTION, rel=1e-6) or max(r.probability for r in expected) == pytest.approx(1)


CELLS = "source string, lang string, topic string, tokens bigint"


def fitted(spark, cells, **targets):
    rows = mixing.raked(spark.createDataFrame(cells, CELLS), targets).collect()
    return {(r.source, r.lang, r.topic): r.weight for r in rows}


def test_cells_of_several_tasks(spark, monkeypatch):
    cells = [(f"s{i % 4}", "ab"[i % 2], "t", 1 + i * i % 17) for i in range(8)]
    cells += [(f"s{i % 4}", "ba"[i % 2], "u", 3 + i) for i in range(8)]
    one = fitted(spark, cells)
    monkeypatch.setattr(mixing, "CELLS_OF_A_TASK", 0)
    monkeypatch.setattr(mixing, "ROUNDS", 3)
    assert fitted(spark, cells) == pytest.approx(one, rel=1e-9)


def test_given_targets_and_many_rounds(spark):
    draw = np.random.default_rng(3)
    # Sources of mostly one language each, nearly cut off from the others: hundreds of rounds.
    cells = [(f"s{i}", "ab"[i % 2], "t", int(draw.integers(500, 1000))) for i in range(6)]
    cells += [(f"s{i}", "ba"[i % 2], "t", 1 + i % 3) for i in range(6)]
    wanted = {"a": 0.51, "b": 0.49}
    got = fitted(spark, cells, lang=wanted, source={f"s{i}": 1.0 for i in range(6)}, topic={"t": 2.0})
    for value, target in wanted.items():
        assert sum(w for k, w in got.items() if k[1] == value) == pytest.approx(target, rel=1e-9)
    for i in range(6):
        assert sum(w for k, w in got.items() if k[0] == f"s{i}") == pytest.approx(1 / 6, rel=1e-9)
    weight = {k: float(n) for *k, n in cells for k in [tuple(k)]}
    for rounds in range(1, 5000):
        off = 0
        for at, target in ((0, dict.fromkeys([f"s{i}" for i in range(6)], 1 / 6)), (1, wanted), (2, {"t": 1.0})):
            sums = {v: sum(w for k, w in weight.items() if k[at] == v) for v in target}
            off = max(off, *(abs(target[v] / sums[v] - 1) for v in target))
            weight = {k: w * target[k[at]] / sums[k[at]] for k, w in weight.items()}
        if off <= mixing.TOLERANCE:
            break
    assert rounds > 400
    assert got == pytest.approx(weight, rel=1e-7)


def test_targets_that_exclude_each_other(spark):
    cells = [("s", "a", "t", 5), ("r", "b", "t", 7)]
    with pytest.raises(ValueError, match="exclude each other"):
        fitted(spark, cells, source={"s": 1, "r": 1}, lang={"a": 1, "b": 3})
    with pytest.raises(ValueError, match="exclude each other"):
        fitted(spark, cells, source={"s": 1}, lang={"b": 1})
    assert fitted(spark, cells, source={"s": 1}, lang={"a": 1}) == {("s", "a", "t"): 1.0, ("r", "b", "t"): 0.0}
