import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitewind.llm import quality as Q

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string, _lang string, cell string"


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(repeated))


def brute_signals(m):
    n_words, chars, symbols, lines, dup, repeat = m
    return {
        "word_length": 100 * chars // n_words if n_words else 0,
        "symbol_rate": 1000 * symbols // n_words if n_words else 0,
        "repeated_line_rate": 1000 * dup // lines if lines else 0,
        "repeated_word_rate": 1000 * repeat // n_words if n_words else 0,
    }


def brute_cell(x):
    drop = max(x.bit_length() - 7, 0)
    return x >> drop << drop


def brute_kept(rows):
    measured = [brute_measures(r[1]) for r in rows]
    failed = [m[0] < 10 or 100 * m[5] > 20 * m[0] for m in measured]
    groups = defaultdict(list)
    for r, m, bad in zip(rows, measured, failed, strict=True):
        if not bad:
            for key in ((r[2], r[3]), (r[2],), ()):
                groups[key].append(brute_signals(m))

    def fence(key, signal):
        cells = sorted(brute_cell(s[signal]) for s in groups[key])
        q1, q3 = (next(c for i, c in enumerate(cells) if 4 * (i + 1) >= k * len(cells)) for k in (1, 3))
        return q1, q3, Q.REACH * max(q3 - q1, Q.SIGNALS[signal][1])

    kept = []
    for r, m, bad in zip(rows, measured, failed, strict=True):
        key = next((k for k in ((r[2], r[3]), (r[2],)) if len(groups.get(k, ())) >= Q.LEAST_DOCUMENTS), ())
        ok = not bad
        if ok:
            for signal, value in brute_signals(m).items():
                q1, q3, reach = fence(key, signal)
                beyond = value - q3
                if Q.SIGNALS[signal][0] == "both":
                    beyond = max(beyond, q1 - value)
                ok &= beyond * m[0] <= reach * (m[0] + Q.FEW_WORDS)
        kept.append(ok)
    return measured, failed, kept


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    words = ["alpha", "be", "Gamma,", "délta", "x", "and", "of", "longerword", "🙂"]
    found = []
    for i in range(700):
        lang, source = draw.choice([("en", "a"), ("en", "a"), ("en", "a"), ("en", "b"), ("de", None), (None, "c")])
        own = [w + lang for w in words] if lang == "de" else words
        text = "".join(draw.choice(own) + draw.choice([" ", " ", " ", "\n", "\t", "  "]) for _ in range(draw.randrange(4, 120)))
        if i % 20 == 0:
            text = text.replace(" ", "#$%& ")
        if i % 20 == 1:
            text = text + "\n" + text[: len(text) // (1 + i % 5)]
        if i % 31 == 0:
            text = "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz " * 2 + text.replace(" ", "qqqqqqqqqqqqqqqqqqqqqqqqqqqqq ")
        found.append((i, text, lang, source))
    found += [(800, None, "en", "a"), (801, "", None, None), (None, "one two " * 8, "en", "a"), (802, " \n\n\x0b", "en", "b"),
              (803, "w " * 20000, "fr", "a"), (5, *found[5][1:]), (804, "a b c d e f a b c d e g h i j k l m n o p q r s", "en", "a")]
    return found


def test_against_plain_python(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    got = Q.judged(docs, ["doc_id"]).collect()
    measured, failed, kept = brute_kept(rows)
    want = sorted(((-1 if r[0] is None else r[0]), *m, f, k) for r, m, f, k in zip(rows, measured, failed, kept, strict=True))
    assert sorted((-1 if r[0] is None else r[0], *r[1:9]) for r in got) == want
    assert 10 < sum(not k and not f for f, k in zip(failed, kept, strict=True)) < 150


def test_cells(spark):
    values = [0, 1, 63, 64, 127, 128, 129, 1000, 12345, 2**40 + 7]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", Q.cell(F.col("v")).alias("c"))
    assert all(r.c == brute_cell(r.v) for r in df.collect())


def test_empty_table(spark):
    assert Q.judged(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.op1_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_lines_of_other_line_ends(spark):
    text = "one two three four five six seven eight nine ten eleven\n \n \nx\n\x85\n\x85\n  "
    docs = spark.createDataFrame([(1, text, "en", "s")], "doc_id bigint, text string, lang string, source string")
    got = Q.judged(docs, ["doc_id"]).first()
    assert (got.n_words, got.n_lines, got.n_dup_lines) == (17, 7, 2)
    assert (got.n_words, got.n_lines, got.n_dup_lines) == tuple(brute_measures(text)[i] for i in (0, 3, 4))


def test_columns_of_any_name_stay(spark):
    names = ["kept", "base_failed", "q_kept", "n_words", *Q.SIGNALS]
    rows = [(i, f"plain words of a text that says nothing much about number {i}", "en", "s", *[f"{n}{i}" for n in names]) for i in range(8)]
    rows += [(9, "short", "en", "s", *names)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    got = Q.passing(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(rows[:8])
    assert {"q_base_failed", "q_q_kept"} <= set(Q.judged(docs, docs.columns).columns)
