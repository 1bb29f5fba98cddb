import random

from sitewind.llm import lines as L
from test_lines_tails import brute as brute_gone

SCHEMA = "doc_id bigint, text string, row string, removed string, digest string"


def brute(rows):
    """Texts after removal: lines of any run of 50 words or more that begins earlier as well go."""
    gone = brute_gone(rows)
    found = {}
    for k, (_, text) in enumerate(rows):
        if text is None:
            found[k] = None
            continue
        runs = []
        for i in gone[k]:
            if runs and i == runs[-1][1] + 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        left = [x for i, x in enumerate(text.split("\n")) if i not in set(gone[k])]
        found[k] = ("\n".join(left), [tuple(r) for r in runs])
    return found


def rows():
    draw = random.Random(6)
    pool = [" ".join(draw.choice("abcdefgh") for _ in range(draw.choice([1, 5, 12, 20, 30, 55, 80]))) for _ in range(60)]
    passage = [pool[i] for i in (1, 7, 9, 3, 20)]
    found = []
    for i in range(150):
        some = [draw.choice(pool) + draw.choice(["", " ", "\r"]) for _ in range(draw.randrange(8))]
        some += [draw.choice(["", "  "])] * (i % 3)
        if i % 3 == 0:
            at = draw.randrange(len(some) + 1)
            some[at:at] = passage[draw.randrange(2) :]
        if i % 7 == 0:
            some = [f"own {i} {x}" for x in some]
        found.append((i, "\n".join(some)))
    found += [(200 + i, found[3][1]) for i in range(60)]
    found += [(300, None), (301, ""), (302, "\n\n"), (303, "a b c\n" * 300), (3, "x " * 60 + "\n" + "x " * 60)]
    return found


def test_against_plain_python(spark):
    data = rows() + [(None, rows()[0][1])]
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in data], SCHEMA).repartition(4)
    got = L.dedup_lines(docs).collect()
    want = brute(data)
    shown = lambda i, t, r: (-1 if i is None else i, t or "", r)
    assert sorted(shown(r.doc_id, r.text, [tuple(x) for x in r.removed]) for r in got) == sorted(
        shown(data[k][0], w and w[0], w[1] if w else []) for k, w in want.items()
    )
    assert sum(bool(w and w[1]) for w in want.values()) > 60
    assert L.dedup_lines(docs).columns == ["doc_id", "text", "row", "digest", "removed"]


def test_equal_rows_and_empty_table(spark):
    text = "\n".join("word " * 30 for _ in range(3)) + "\nend"
    docs = spark.createDataFrame([(1, text)] * 5, "doc_id bigint, text string")
    got = sorted(r.text for r in L.dedup_lines(docs).collect())
    # The first keeps its lines but those that repeat inside it, the others keep none.
    assert got[:4] == [""] * 4 and got[4].endswith("end") and len(got[4]) > 100
    assert L.dedup_lines(docs.limit(0)).count() == 0
