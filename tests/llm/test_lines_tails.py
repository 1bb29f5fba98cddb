import random
from itertools import accumulate

from sitewind.llm import lines as L

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Lines removed of each row: those of any run of 50 words or more that begins earlier as well,
    in whatever place, found by trying all runs."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, found = set(), {}
    for k in order:
        whole = (rows[k][1] or "").split("\n")
        real = [i for i, x in enumerate(whole) if x.strip(WHITE)]
        text = [whole[i].strip(WHITE) for i in real]
        upto = [0, *accumulate(len(x.encode().split()) for x in text)]
        gone = set()
        for s in range(len(real)):
            runs = [e for e in range(s + 1, len(real) + 1) if upto[e] - upto[s] >= 50]
            for e in runs:
                if tuple(text[s:e]) in seen:
                    gone.update(range(real[s], real[e - 1] + 1))
            # Later places of the same text may repeat this one.
            seen.update(tuple(text[s:e]) for e in runs)
        found[k] = sorted(gone)
    return found


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = L.dedup_lines(docs).collect()
    return {r.doc_id: [i for x in r.removed for i in range(x.first, x.last + 1)] for r in got}


def words(n, name):
    return " ".join(f"{name}{i}" for i in range(n))


def test_runs_are_removed_to_their_last_line(spark):
    short = "\n".join(words(n, c) for n, c in ((25, "a"), (25, "b"), (3, "c")))
    long = "\n".join(words(n, c) for n, c in ((60, "d"), (30, "e")))
    # The first place of a window is not the one where the run goes on furthest.
    first, other = "\n".join([words(60, "f"), "x"]), "\n".join([words(60, "f"), "y y"])
    rows = [(1, short), (2, f"own\n{short}\nown"), (3, long), (4, long), (5, first), (6, other), (7, other)]
    assert removed(spark, rows) == {1: [], 2: [1, 2, 3], 3: [], 4: [0, 1], 5: [], 6: [0], 7: [0, 1]}


def test_against_all_runs(spark):
    draw = random.Random(8)
    pool = [words(draw.choice([1, 3, 12, 20, 30, 49, 50, 60]), f"w{i}_") for i in range(14)]
    passage = [pool[i] for i in (1, 7, 9, 3, 10)]
    rows = []
    for i in range(120):
        some = [draw.choice(pool) + draw.choice(["", " ", "\r"]) for _ in range(draw.randrange(7))]
        at = draw.randrange(len(some) + 1)
        some[at:at] = ["", *passage[draw.randrange(3) : draw.randrange(3, 6)]]
        rows.append((i, "\n".join(some)))
    want = brute(rows)
    assert removed(spark, rows) == want
    assert sum(map(bool, want.values())) > 60
