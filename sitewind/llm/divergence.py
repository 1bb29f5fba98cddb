"""How far the sources of a language differ in their terms.

Terms are counted in the tasks that read the texts. Those of enough documents get numbers, in blocks of
bounded size; per block, a group (language and source) is one pair of sorted arrays, of term numbers
and counts. A task has the arrays of two groups: the shorter is searched in the longer, which
prices the terms of both, of one alone, and, by their number, of neither.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewind.llm.common import documents, staged

#: Shares are whole numbers of this part, and one more.
ONE = 1_000_000_000
#: Documents of its language that a term needs, and terms listed of each group.
LEAST_DOCUMENTS = 10
TERMS = 10
#: Terms of a block, about; entries that a task counts before it hands them on; bytes of text at once.
BLOCK = 50_000
HELD = 400_000
TEXT_AT_ONCE = 4 << 20

# ASCII letters in lower case and all bytes of other characters stay; the rest is between terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)
_COUNTS = "lang string, source string, term binary, n bigint, docs bigint"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    at = 0
    while at < len(text):
        end = text.find(b" ", min(at + TEXT_AT_ONCE, len(text)))
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict = defaultdict(Counter)
    documents_of: dict = defaultdict(Counter)
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            within = documents_of[lang, source]
            n = len(found)
            # A row without a term says that the group occurs.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (n + 1), pa.string()),
                    pa.array([source] * (n + 1), pa.string()),
                    pa.array([None, *found], pa.binary()),
                    pa.array([0, *found.values()], pa.int64()),
                    pa.array([0, *(within[t] for t in found)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            mine, within = counts[lang, source], documents_of[lang, source]
            before, distinct = len(mine), set()
            for terms in _pieces(text.translate(_TERM_BYTES)):
                mine.update(terms)
                distinct.update(terms)
            within.update(distinct)
            held += len(mine) - before
            if held >= HELD:
                yield from rows()
                counts.clear()
                documents_of.clear()
                held = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and documents there that have
    it, and one row with a null term per group. Null text, lang and source count as empty."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    # A text is unread after its batch, and batches are cut by their rows: few of them at once.
    return (
        rows.mapInArrow(_count, _COUNTS)
        .groupBy("lang", "source", F.col("term").cast("string").alias("term"))
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _share(count: Column, whole: Column) -> Column:
    """1 + floor(ONE * (count + 2) / whole), in decimals, which hold it for any BIGINT."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")
    return F.call_function("div", scaled, whole.cast("decimal(20,0)")) + 1


def _shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """The same for arrays. Divided in three steps of a thousand each, so that no product passes 63
    bits while totals are below 9e15; beyond, with Python's whole numbers."""
    if whole >= 9_000_000_000_000_000:
        return np.array([1 + ONE * (c + 2) // whole for c in counts.tolist()], np.int64)
    rest = counts.astype(np.int64) + 2
    found = rest // whole
    rest %= whole
    for _ in range(3):
        rest *= 1000
        found = found * 1000 + rest // whole
        rest %= whole
    return found + 1


def _price(p: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def merged(left: tuple, right: tuple, whole_left: int, whole_right: int) -> tuple[int, int]:
    """(terms of either, their prices added up) of two groups, each given as sorted term numbers and
    their counts. The shorter one is searched in the longer one; order doesn't matter for prices."""
    if len(left[0]) > len(right[0]):
        left, right, whole_left, whole_right = right, left, whole_right, whole_left
    (few, counts_few), (many, counts_many) = left, right
    place = np.searchsorted(many, few)
    hit = np.zeros(len(few), bool)
    inside = place < len(many)
    hit[inside] = many[place[inside]] == few[inside]
    p, q = _shares(counts_few, whole_left), _shares(counts_many, whole_right)
    none = np.zeros(1, np.int64)
    p_absent, q_absent = int(_shares(none, whole_left)[0]), int(_shares(none, whole_right)[0])
    alone = np.ones(len(many), bool)
    alone[place[hit]] = False
    total = (
        int(_price(p[hit], q[place[hit]]).sum())
        + int(_price(p[~hit], q_absent).sum())
        + int(_price(q[alone], p_absent).sum())
    )
    return len(few) + int(alone.sum()), total


def _packed(table: pa.Table) -> pa.Table:
    """The arrays of one group and block, sorted by term number, in one row."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    ids, counts = ids[order].astype("<i4"), table.column("n").to_numpy()[order].astype("<i8")
    packed = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in (np.diff(ids, prepend=np.int32(0)), counts)]
    first = table.slice(0, 1)
    return pa.table({
        "lang": first.column("lang"), "source": first.column("source"), "block": first.column("block"),
        "size": pa.array([len(ids)]), "ids": pa.array([packed[0]], pa.binary()), "counts": pa.array([packed[1]], pa.binary()),
    })


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if not table.num_rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    row = {c: table.column(c)[0].as_py() for c in ("size", "ids", "counts")}
    ids, counts = (
        np.frombuffer(pa.decompress(row[c], row["size"] * w, "zstd"), f"<i{w}") for c, w in (("ids", 4), ("counts", 8))
    )
    return np.cumsum(ids, dtype=np.int32), counts


def _pair(left: pa.Table, right: pa.Table) -> pa.Table:
    one = (left if left.num_rows else right).slice(0, 1)
    names = ["lang", "low", "high", "whole_low", "whole_high"]
    row = {c: one.column(c)[0].as_py() for c in names}
    terms, value = merged(_unpacked(left), _unpacked(right), row["whole_low"], row["whole_high"])
    return pa.table({
        "lang": one.column("lang"), "low": one.column("low"), "high": one.column("high"),
        "terms": pa.array([terms]), "value": pa.array([value]),
    })


def _halves(pairs: DataFrame, packs: DataFrame, side: str) -> DataFrame:
    mine = packs.withColumnRenamed("source", side)
    names = ["lang", "low", "high", "block", "whole_low", "whole_high", "size", "ids", "counts"]
    return pairs.join(mine, ["lang", side]).select(*names).toDF(*names)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (text, lang, source; others aren't read).

    Part ``pair``: how far each other source of the language is; part ``term``: the terms that a
    group has most above its language, at most ``terms``. Rows that repeat count as often. A
    language without a term of ``least`` documents has pairs of value 0, one with one source only
    terms; an empty table has no rows.
    """
    counted = staged(term_counts(docs), "term-counts")
    found = counted.where("term is not null")
    vocabulary = staged(
        found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(
            F.col("docs") >= least
        ).drop("docs"),
        "vocabulary",
    )
    blocks = max(1, -(-vocabulary.count() // BLOCK))
    numbered = vocabulary.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).withColumn(
        # A block of a language holds about BLOCK terms.
        "id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    )
    kept = staged(found.drop("docs").join(numbered, ["lang", "term"]), "kept-terms")

    # One row per language, one per group.
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("n_all"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    zero = F.lit(0).cast("bigint")
    groups = staged(
        counted.where("term is null").select("lang", "source")
        .join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        .select(
            "lang", "source",
            F.coalesce("v", zero).alias("v"),
            (F.coalesce("n_group", zero) + 2 * F.coalesce("v", zero)).alias("whole"),
            (F.coalesce("n_all", zero) + 2 * F.coalesce("v", zero)).alias("whole_lang"),
        ),
        "groups",
    )
    by_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    listed = (
        kept.join(groups, ["lang", "source"])
        .select(
            "lang", "source", F.col("term").alias("item"),
            _share(F.col("n"), F.col("whole")).alias("p"), _share(F.col("n_lang"), F.col("whole_lang")).alias("q"),
        )
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
        .withColumn("rank", F.row_number().over(by_group))
        .where(F.col("rank") <= terms)
    )

    low = groups.select("lang", F.col("source").alias("low"), F.col("whole").alias("whole_low"), "v")
    high = groups.select("lang", F.col("source").alias("high"), F.col("whole").alias("whole_high"))
    pairs = staged(low.join(high, "lang").where("low < high"), "pairs")
    packs = staged(
        kept.select("lang", "source", "block", "id", "n").groupBy("lang", "source", "block").applyInArrow(
            _packed, "lang string, source string, block int, size bigint, ids binary, counts binary"
        ),
        "packs",
    )
    keys = ["lang", "low", "high", "block"]
    priced = (
        _halves(pairs, packs, "low").groupBy(*keys)
        .cogroup(_halves(pairs, packs, "high").groupBy(*keys))
        .applyInArrow(_pair, "lang string, low string, high string, terms bigint, value bigint")
        .groupBy("lang", "low", "high").agg(F.sum("terms").alias("terms"), F.sum("value").alias("value"))
    )
    nothing = F.lit(0).cast("bigint")
    absent = F.expr("((p - q) * (p - q)) div (p + q)")
    valued = staged(
        pairs.join(priced, ["lang", "low", "high"], "left")
        .withColumns({
            "p": F.when(F.col("v") > 0, _share(nothing, F.col("whole_low"))),
            "q": F.when(F.col("v") > 0, _share(nothing, F.col("whole_high"))),
        })
        .select(
            "lang", "low", "high",
            (F.coalesce("value", zero) + F.coalesce((F.col("v") - F.coalesce("terms", zero)) * absent, zero)).alias("value"),
        ),
        "priced-pairs",
    )
    both = valued.select("lang", F.col("low").alias("source"), F.col("high").alias("item"), "value").union(
        valued.select("lang", F.col("high").alias("source"), F.col("low").alias("item"), "value")
    )
    ranked = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(by_group)
    )
    return ranked.union(listed)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that set them apart."""
    return audit(documents(spark, sf_dir))


def oracle() -> str:
    """The query in SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"(1 + ({ONE}::hugeint * ({{n}} + 2)) // ({{whole}}))"
    return f"""with docs as materialized (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
            from documents),
        words as (select row, lang, source, unnest(terms) as term from docs),
        counted as materialized (select lang, source, term, count(*) as n, count(distinct row) as docs from words group by all),
        vocabulary as materialized (
            select lang, term, sum(n) as n_lang from counted group by all having sum(docs) >= {LEAST_DOCUMENTS}),
        kept as materialized (select c.* from counted c join vocabulary using (lang, term)),
        langs as (select lang, count(*) as v, sum(n_lang) as n_all from vocabulary group by all),
        groups as materialized (
            select lang, source, coalesce(v, 0) as v, coalesce(n_all, 0) + 2 * coalesce(v, 0) as whole_lang,
                coalesce((select sum(n) from kept k where k.lang = g.lang and k.source = g.source), 0) + 2 * coalesce(v, 0) as whole
            from (select distinct lang, source from docs) g left join langs using (lang)),
        shares as materialized (
            select g.lang, g.source, t.term, coalesce(k.n, 0) as n, {share.format(n="coalesce(k.n, 0)", whole="g.whole")} as p,
                {share.format(n="t.n_lang", whole="g.whole_lang")} as q
            from groups g join vocabulary t using (lang) left join kept k using (lang, source, term)),
        pairs as (
            select a.lang, a.source, 'pair' as part, b.source as item,
                sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
            union all
            select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b
            on a.lang = b.lang and a.source <> b.source where a.v = 0),
        listed as (
            select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // (p + q) as value
            from shares where n > 0 and p > q),
        ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
            from (from pairs union all from listed))
        select lang, source, part, item, value::bigint as value, rank::int as rank
        from ranked where part = 'pair' or rank <= {TERMS}"""
