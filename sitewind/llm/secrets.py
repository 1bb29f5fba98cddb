"""Secrets in texts: three fixed patterns, and strings of high entropy.

Places come from cutting a text at the matches of a pattern: what lies between them and the matches
have lengths, and their running sum is where each match begins. All are column expressions over
one row, so nothing is shuffled and a text of any length stays in its row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm.common import documents, let, text_or_empty

# Patterns of the base, in their order; least characters of the group named.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A match goes as far as its characters do, so one that is long enough can be asked for at once, and
# shorter runs, of which a text may have one per word, are no matches to look at.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}
KINDS = [*BASE, "entropy"]

#: Characters of candidates, and how many of them in a row make one.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
WINDOW = 20
CANDIDATE = f"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{{{WINDOW},}}"
#: Character classes, narrowest first: pattern of a whole candidate, bits a character at least that
#: a window of it must have.
CLASSES = {
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9),
    "alnum": ("^[A-Za-z0-9]+$", 3.6),
    "base64": ("^[A-Za-z0-9+/=_-]+$", 3.8),
}
#: Strings of high entropy that are no secrets: what windows of a candidate merge to is held against
#: these, not the candidate, so a path or a name beside a secret doesn't hide it. Letters alone are
#: words if their cases, or characters between them, make words of them: two small letters or more,
#: with or without a capital, a capital and a small letter of which one is a vowel, or capitals
#: together; at either end words may be cut. Possessive, so that the engine doesn't go a level deeper
#: for each of many words.
ALLOWED = {
    "number": "^[0-9+/=_-]+$",
    "words": "^[a-z]*+(?:[+/=_-]*+(?:[A-Z]?[a-z]{2,}+|[AEIOU][a-z]|[A-Z][aeiouy]|[A-Z]{2,}+))*+[+/=_-]*+[A-Z]?[a-z]?$",
    "words and numbers": "^[+/=_-]*+(?:(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]{1,4}+)[+/=_-]++)++(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]{1,4}+)?$",
    "uuid": "^(?i:[0-9a-f]{0,8}(?:-[0-9a-f]{4}){2,3}(?:-[0-9a-f]{0,12})?)$",
    "placeholder": "^.{0,32}(?i:example|placeholder)(?i:key|token|secret)?$",
}
#: Of these, any part of a string that is one is one, too.
_CLOSED = ("number", "words and numbers")
_SCALE = 1_000_000

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _sums(lengths: Column) -> Column:
    """Running sums of an array. Summed in blocks of as many as there are blocks, so that what is copied
    to make one number longer stays short."""

    def running(values: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(F.lit(0).alias("sum"), F.expr("cast(array() as array<int>)").alias("out")),
            lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.concat(s["out"], F.array(s["sum"] + v)).alias("out")),
        )["out"]

    def whole(x: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(x["all"]))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.size(x["all"]) - 1, size),
            lambda at: running(F.slice(x["all"], at + 1, size)),
        )
        return let(
            blocks,
            lambda b: F.flatten(F.zip_with(
                b, running(F.transform(b, lambda part: F.element_at(part, -1))),
                lambda part, end: F.transform(part, lambda v: v + end - F.element_at(part, -1)),
            )),
        )

    return let(
        F.struct(lengths.alias("all")),
        lambda x: F.when(F.size(x["all"]) == 0, F.expr("cast(array() as array<int>)")).otherwise(whole(x)),
    )


def _places(text: Column, pattern: str) -> Column:
    """Start of each match, in code points, with the match: ARRAY<STRUCT<start, text>>."""
    return let(
        F.struct(
            F.split(text, pattern, -1).alias("between"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        ),
        lambda x: let(
            F.struct(
                x["found"].alias("found"),
                _sums(F.zip_with(
                    F.slice(x["between"], 1, F.size(x["found"])), x["found"],
                    lambda b, m: F.length(b) + F.length(m),
                )).alias("ends"),
            ),
            lambda y: F.zip_with(
                y["ends"], y["found"], lambda end, m: F.struct((end - F.length(m)).alias("start"), m.alias("text"))
            ),
        ),
    )


def _base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE[kind]
    places = _places(text, pattern)
    if group:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        places = F.filter(
            F.zip_with(places, values, lambda p, v: F.struct(p["start"].alias("start"), p["text"].alias("text"), F.length(v).alias("n"))),
            lambda p: p["n"] >= least,
        )
    else:
        places = F.filter(places, lambda p: F.length(p["text"]) >= least)
    return F.transform(
        places, lambda p: _span(p["start"], KINDS.index(kind), p["start"] + F.length(p["text"]))
    ).cast(_SPANS)


def _terms() -> Column:
    """n * log2(n) for counts up to the window, as whole numbers."""
    return F.array(*[F.lit(round(_SCALE * n * math.log2(n)) if n else 0) for n in range(WINDOW + 1)])


def _most(bits: float) -> int:
    """The sum of n * log2(n) over a window's characters that goes with so many bits a character."""
    return round(_SCALE * WINDOW * (math.log2(WINDOW) - bits))


def _entropy_spans(candidate: Column) -> Column:
    """Windows of a candidate with high entropy, merged. A step takes one character in and one out,
    and changes the two counts and the sum that the entropy follows from."""
    most = F.coalesce(*[F.when(candidate["text"].rlike(p), F.lit(_most(bits))) for p, bits in CLASSES.values()])

    def scan(x: Column) -> Column:
        codes, terms = x["codes"], x["terms"]

        def step(s: Column, i: Column) -> Column:
            code = F.get(codes, i)
            gone = F.coalesce(F.get(codes, i - WINDOW), F.lit(-1))
            freed = let(
                F.get(s["counts"], gone),
                lambda n: F.coalesce(F.get(terms, n - 1) - F.get(terms, n), F.lit(0)),
            )
            left = F.transform(s["counts"], lambda n, k: F.when(k == gone, n - 1).otherwise(n))
            return let(
                F.struct(left.alias("counts"), (s["sum"] + freed).alias("sum")),
                lambda t: let(
                    F.struct(
                        F.transform(t["counts"], lambda n, k: F.when(k == code, n + 1).otherwise(n)).alias("counts"),
                        (t["sum"] + F.get(terms, F.get(t["counts"], code) + 1) - F.get(terms, F.get(t["counts"], code))).alias("sum"),
                    ),
                    lambda u: F.struct(
                        u["counts"].alias("counts"),
                        u["sum"].alias("sum"),
                        F.when((i < WINDOW - 1) | (u["sum"] > x["most"]), s["out"])
                        .when(
                            F.coalesce(F.try_element_at(s["out"], F.lit(-1))["end"] >= i - WINDOW + 1, F.lit(False)),
                            F.concat(
                                F.slice(s["out"], 1, F.size(s["out"]) - 1),
                                F.array(F.struct(F.try_element_at(s["out"], F.lit(-1))["start"].alias("start"), (i + 1).alias("end"))),
                            ),
                        )
                        .otherwise(F.concat(s["out"], F.array(F.struct((i - WINDOW + 1).alias("start"), (i + 1).alias("end")))))
                        .alias("out"),
                    ),
                ),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1),
            F.struct(
                F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
                F.lit(0).alias("sum"),
                F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"),
            ),
            step,
        )["out"]

    codes = F.transform(F.split(candidate["text"], ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    found = let(F.struct(codes.alias("codes"), _terms().alias("terms"), most.alias("most")), scan)
    return F.transform(
        found,
        lambda w: _span(candidate["start"] + w["start"], KINDS.index("entropy"), candidate["start"] + w["end"]),
    )


def _allowed(string: Column, names: Iterable[str] = ALLOWED) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | string.rlike(ALLOWED[name])
    return found


def _suspect_spans(candidate: Column) -> Column:
    """Merged windows of a candidate that are not allowed."""
    return F.filter(
        _entropy_spans(candidate),
        lambda s: ~_allowed(
            candidate["text"].substr(s["start"] - candidate["start"] + 1, s["end"] - s["start"])
        ),
    )


def spans(text: Column) -> Column:
    """All secrets of a text, ARRAY<STRUCT<start, kind, end>> by start, then kind (its place in
    ``KINDS``), in code points, the end outside. Null or empty texts have none."""
    none = F.expr(f"cast(array() as {_SPANS})")
    # A cheap test first: few texts have a match.
    base = F.concat(
        F.when(text.rlike(ASSIGN), _base_spans(text, "assign")).otherwise(none),
        F.when(text.contains("AKIA"), _base_spans(text, "access")).otherwise(none),
        F.when(text.rlike(HEX), _base_spans(text, "hex")).otherwise(none),
    )
    candidates = F.filter(_places(text, CANDIDATE), lambda c: ~_allowed(c["text"], _CLOSED))
    entropy = F.when(
        text.rlike(CANDIDATE), F.flatten(F.transform(candidates, _suspect_spans)).cast(_SPANS)
    ).otherwise(none)
    return let(
        F.struct(base.alias("base"), entropy.alias("entropy")),
        lambda x: F.array_sort(
            F.concat(
                x["base"],
                # What a pattern has found already is no further span.
                F.filter(
                    x["entropy"],
                    lambda e: ~F.exists(x["base"], lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])),
                ),
            )
        ),
    )


def secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``secrets``, as ``spans`` gives it; one of that name is replaced."""
    return docs.withColumn("secrets", spans(text_or_empty()))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the number of matches of each pattern, a digest of them, and all spans."""
    found = secrets(documents(spark, sf_dir).select("doc_id", "text"))
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == KINDS.index(kind))
    base = F.filter("secrets", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("secrets")).alias("spans"),
    )
