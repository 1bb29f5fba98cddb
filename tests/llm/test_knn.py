import math
import random

import numpy as np
import pytest

from sitewind.llm import knn

SCHEMA = "vec_id bigint, embedding array<double>, row string, cell string, score string"


def brute(rows, k=20, every=20):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, a in usable:
        if q % every == 0:
            scores = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in usable if i != q)[:k]
            found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(found)


def got(spark, rows, **more):
    docs = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, knn.nearest(docs, **more).collect()))


def test_clusters_copies_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "GROUP", 7)
    monkeypatch.setattr(knn, "SHARE", 100)
    monkeypatch.setattr(knn, "BLOCK", 30)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(6, 5)) * 3
    rows = [(i, (centres[i % 6] + draw.normal(size=5) * 0.05).tolist()) for i in range(300)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(300, 420)]
    rows += [(500, None), (520, [1.0, None, 2.0]), (540, [float("nan")] * 5), (560, [float("inf")] * 5), (580, []),
             (600, [1.0, 2.0]), (None, [9.0] * 5), (-20, [-1.0] * 5), (601, [1.0] * 7)]
    assert got(spark, rows) == brute(rows)


def test_repeated_ids_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.25])]
    assert got(spark, rows) == [(0, 1, 1, 2048), (0, 2, 1, 2048), (0, 3, 2, -4096)]
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0])]) == []


def test_numbers_that_doubles_cannot_hold(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([1e8, 3.0, -2e7]) * draw.random() for _ in range(3)]) for i in range(50)] + [(60, [1e12, 1e12, 1.0])]
    assert got(spark, rows, every=5) == brute(rows, every=5)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, knn.op7_voronoi_knn(spark, folder).collect())) == brute(rows)


def test_whole_cells_are_left_out(spark, monkeypatch):
    """With clusters that lie apart, a group's blocks are those of its own cluster: the summaries leave
    out the others, and the files are asked for the bounds."""
    monkeypatch.setattr(knn, "BLOCK", 20)
    monkeypatch.setattr(knn, "SHARE", 40)
    seen = {}

    def needed(blocks, enough):
        found = needed_blocks(blocks, enough)
        seen.update(blocks=blocks, enough=enough, needed=found)
        return found

    needed_blocks = knn.needed_blocks
    monkeypatch.setattr(knn, "needed_blocks", needed)
    draw = np.random.default_rng(3)
    centres = np.eye(8) * 5
    rows = [(i, (centres[i // 5 % 8] + draw.normal(size=8) * 0.01).tolist()) for i in range(1600)]
    assert got(spark, rows) == brute(rows)
    pairs = seen["blocks"].count() * len(seen["enough"])
    sent = seen["needed"].count()
    vectors = sum(len(r.ids) // 8 for r in seen["needed"].collect())
    assert len(seen["enough"]) >= 8 and 0 < sent < pairs / 3 and vectors <= 1600 * len(seen["enough"]) / 3
    plan = seen["needed"]._jdf.queryExecution().toString()
    assert any("high_" in line for line in plan.splitlines() if "PushedFilters" in line)


def test_copies_of_a_query_bound_nothing(spark):
    """Rows of a query's own id are no candidates, so they may not raise what others must reach."""
    rows = [(0, [9.0, 9.0])] * 40 + [(i, [i / 100, 1.0]) for i in range(1, 60)]
    assert got(spark, rows) == brute(rows)
