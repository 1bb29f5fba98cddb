import hashlib

import corpus_pipeline as P
from sitewind.llm import simhash
from sitewind.llm.common import staged
from test_lines import brute as brute_lines
from test_quality import brute_kept
from test_simhash import brute_components, brute_print

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert docs.columns == COLUMNS
    for n, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, FOLDER)
        old = [tuple(r) for r in docs.collect()]
        new = [tuple(r) for r in out.collect()]
        if n < 4:
            assert out.columns == COLUMNS
        if n == 0:
            kept = brute_kept([(r[0], r[1], r[2], r[3]) for r in old])[2]
            assert sorted(new) == sorted(r for r, k in zip(old, kept, strict=True) if k)
        elif n == 1:
            texts = brute_lines([(r[0], r[1]) for r in old])
            assert sorted(new) == sorted((r[0], texts[k][0], r[2], r[3], len(texts[k][0])) for k, r in enumerate(old))
        elif n == 2:
            prints = {r[0]: brute_print(r[1]) for r in old}
            root = brute_components(set(prints.values()))
            least = {}
            for i, p in prints.items():
                least[root[p]] = min(least.get(root[p], i), i)
            assert sorted(new) == sorted(r for r in old if r[0] in set(least.values()))
        elif n == 3:
            assert 0 < len(new) <= len(old) and set(new) <= set(old)
        else:
            texts = {r[0]: r[1] for r in old}
            assert len(new) == len(old)
            for r in out.collect():
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert sorted(r.doc_id for r in P.run(spark, FOLDER).collect()) == sorted(r[0] for r in new)


def test_one_of_equal_rows_stays(spark):
    schema = "row string, doc_id bigint, text string, print string"
    docs = spark.createDataFrame([("a", 1, "x y z", "")] * 3 + [("b", None, "x y z", "")] * 2 + [("c", None, "q r s", "")] * 2 + [("d", 9, None, ""), ("e", 8, "", "")], schema)
    got = simhash.one_of_each(docs).collect()
    assert sorted(r.row for r in got) == ["a", "c", "e"]


def test_near_duplicates_broadcast_nothing(spark, monkeypatch):
    """Neither places of fingerprints nor labels: both grow with the documents."""
    plans = []

    def planned(df, name, by=None):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name, by)

    monkeypatch.setattr(simhash, "staged", planned)
    monkeypatch.setattr("sitewind.llm.components.staged", planned)
    docs = spark.createDataFrame([(i, f"w{i % 7} x y z") for i in range(50)], "doc_id bigint, text string")
    assert simhash.one_of_each(docs).count() == 7
    places, kept = (next(plan for name, plan in plans if name == n) for n in ("links", "kept"))
    for plan in (places, kept):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in P.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_columns_of_any_name_go_through_every_stage(spark):
    names = ["kept", "removed", "topic", "base_failed", "probability", "row", "print"]
    text = "plain words of a text that says nothing much about the number {} of it all"
    rows = [(i, text.format(i), "en", "s", 70, *[f"{n}{i}" for n in names]) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names))
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        assert {tuple(r)[5:] for r in out.collect()} <= {r[5:] for r in rows}
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert P.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
