"""Mixing sources, languages and topics to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic); each round scales the cells to the target of
each source, then of each language, then of each topic, until all marginals hold. What a cell's
weight is to its tokens gives, scaled so that no cell gives more than it has, the probability with
which its documents stay.

Only the cells are fitted, one row each, whatever the documents are; all is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewind.llm.common import documents, staged, word_array

#: Topics by what a text holds anywhere, the first that fits; the others are PROSE.
TOPICS = {
    "legal": r"(?i)\b(?:licen[sc]e|copyright|warranty)\b",
    "contact": r"@[A-Za-z0-9-]+\.[A-Za-z]{2,}",
    "markup": r"https?://|</?[a-z]+>",
    "numeric": r"[0-9]{4}",
}
PROSE = "prose"

MARGINS = ("source", "lang", "topic")
#: Targets are in proportion to this power of a value's tokens unless others are given, which raises
#: small sources and lowers large ones. Tokens that stay are at most FRACTION of all, and fewer where
#: the cells can't give the targets that many: then some cell is kept whole.
TEMPER = 0.9
FRACTION = 0.75
#: Rounds end when no marginal is off by more than this part of its target. ROUNDS of them are one
#: job; if the residual hasn't fallen by STALLED over these, the marginals exclude each other, which is
#: an error.
TOLERANCE = 1e-10
ROUNDS = 5
STALLED = 0.9999
#: Cells that one task can sum and sort; beyond, tasks share them by the values of each margin.
CELLS_OF_A_TASK = 500_000
SEED = 17


def topic(text: Column) -> Column:
    found = F.lit(PROSE)
    for name, pattern in reversed(TOPICS.items()):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def n_tokens(text: Column) -> Column:
    return F.size(word_array(text)).cast("bigint")


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that follows from an id."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{SEED}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def cells(rows: DataFrame) -> DataFrame:
    """Tokens by source, language and topic; nulls are values like others. Cells without tokens
    have no weight and are left out."""
    return rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")


def _with_targets(cells: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``cells`` with the target of each margin's value, shares of the values that occur."""
    for margin in MARGINS:
        given = targets.get(margin)
        values = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("sum"))
        if given is None:
            weight, mine = F.pow("sum", F.lit(TEMPER)), F.pow(
                F.sum(F.col("tokens").cast("double")).over(Window.partitionBy(margin)), F.lit(TEMPER)
            )
        else:
            pairs = [F.lit(x) for pair in given.items() for x in (pair[0], float(pair[1]))]
            weight = F.coalesce(F.create_map(*pairs)[F.col(margin)], F.lit(0.0)) if pairs else F.lit(0.0)
            mine = weight
        total = values.agg(F.sum(weight).alias("w")).scalar()
        cells = cells.withColumn(f"target_{margin}", F.try_divide(mine, total))
    return cells


def _round(cells: DataFrame) -> DataFrame:
    """Cells scaled to the targets of each margin in turn; ``off`` is how far its marginals were."""
    names = [c for c in cells.columns if c not in ("weight", "off")]
    off = F.lit(0.0)
    for margin in MARGINS:
        target = F.col(f"target_{margin}")
        # A margin's values are few, and of each the task that sums them has its cells, not documents.
        summed = cells.withColumn("_sum", F.sum("weight").over(Window.partitionBy(margin)))
        factor = F.try_divide(target, F.col("_sum"))
        cells = summed.select(
            *names,
            F.when(target > 0, F.col("weight") * F.coalesce(factor, F.lit(0.0))).otherwise(F.lit(0.0)).alias("weight"),
            F.when(target > 0, F.greatest(off, F.coalesce(F.abs(factor - 1), F.lit(1.0)))).otherwise(off).alias("off"),
        )
        off = F.col("off")
    return cells


def raked(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """``cells`` with ``weight``, shares that add up to 1 and whose marginals are the targets.

    A ValueError says how far the marginals stay off where no weights have them.
    """
    now = staged(
        _with_targets(cells, targets or {}).withColumn("weight", F.col("tokens").cast("double")), "raked"
    )
    # Cells that fit in one task are not shuffled for each of the sums.
    few = now.count() <= CELLS_OF_A_TASK
    before = None
    while True:
        now = now.coalesce(1) if few else now
        for _ in range(ROUNDS):
            now = _round(now)
        now = staged(now, "raked")
        off = now.agg(F.max("off")).first()[0]
        if off is None or off <= TOLERANCE:
            return now.drop("off")
        if before is not None and off > before * STALLED:
            raise ValueError(f"the targets exclude each other: a marginal stays off by {off:.3g} of its target")
        before = off


def calibrated(raked: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """``raked`` with ``probability``: tokens stay in the raked proportions, ``fraction`` of all or as
    many as there can be without a cell giving more than it has."""
    least = raked.agg(
        F.least(
            F.lit(float(fraction)) * F.sum("tokens").cast("double"),
            F.min(F.when(F.col("weight") > 0, F.col("tokens") / F.col("weight"))),
        ).alias("scale")
    ).scalar()
    ratio = F.col("weight") / F.col("tokens")
    return raked.withColumn("probability", F.least(F.lit(1.0), ratio * least))


def _decided(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, fraction: float
) -> DataFrame:
    """The columns of ``docs`` by number, with topic, n_tokens, probability and kept."""
    names = docs.columns
    at = {c: F.col(f"_{i}") for i, c in enumerate(names)}
    text = F.coalesce(at["text"], F.lit(""))
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)]).select(
        "*", topic(text).alias("topic"), n_tokens(text).alias("n_tokens"),
        *[at[m].cast("string").alias(m) for m in MARGINS if m != "topic"],
    )
    found = calibrated(raked(staged(cells(rows), "cells"), targets), fraction)
    found = staged(
        found.select(*[F.col(m).alias(f"mix_{m}") for m in MARGINS], F.col("probability").alias("chance")),
        "probabilities",
    )
    same = [F.col(m).eqNullSafe(F.col(f"mix_{m}")) for m in MARGINS]
    probability = F.coalesce("chance", F.lit(1.0))
    return rows.join(found, same[0] & same[1] & same[2], "left").withColumns(
        {"probability": probability, "kept": draw(at["doc_id"]) < probability}
    )


def mixed(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, fraction: float = FRACTION
) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept (columns of these names are replaced).

    A null text counts as empty. Documents of a cell without any token stay. A draw follows from
    the doc_id alone, so rows that repeat one share its fate if their cell is the same. ``targets``
    may give weights by value for any of source, lang and topic; values it doesn't name get none.
    """
    more = ["topic", "n_tokens", "probability", "kept"]
    own = [F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in more]
    return _decided(docs, targets, fraction).select(*own, *more)


def sampled(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, fraction: float = FRACTION
) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they have, whatever their names."""
    own = [F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)]
    return _decided(docs, targets, fraction).where("kept").select(*own)


def op5_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the probability of their cell and whether they stay."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    return mixed(docs).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def oracle() -> str:
    """The query in SQL, which repeats its rounds until the marginals hold."""
    kind = " ".join(f"when regexp_matches(text, '{p}') then '{name}'" for name, p in TOPICS.items())
    targets = ", ".join(
        f"pow(sum(tokens) over (partition by {m})::double, {TEMPER}) / (select sum(w) from"
        f" (select pow(sum(tokens)::double, {TEMPER}) as w from cells group by {m})) as t_{m}"
        for m in MARGINS
    )
    step, keys = "rake", ", ".join(MARGINS) + ", tokens, " + ", ".join(f"t_{m}" for m in MARGINS)
    for m in MARGINS:
        off = "0.0" if m == MARGINS[0] else "off"
        step = f"""(select {keys}, w * t_{m} / s as w, greatest({off}, abs(t_{m} / s - 1)) as off, residual, round
            from (select *, sum(w) over (partition by {m}) as s from {step}))"""
    return f"""with recursive docs as materialized (select doc_id, source, lang, case {kind} else '{PROSE}' end as topic,
            len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens
            from (select doc_id, source, lang, coalesce(text, '') as text from documents)),
        cells as materialized (select source, lang, topic, sum(n_tokens) as tokens
            from docs group by all having sum(n_tokens) > 0),
        rake as (
            select *, tokens::double as w, 0::double as off, 1::double as residual, 0 as round
            from (select source, lang, topic, tokens, {targets} from cells)
            union all
            select {keys}, w, off, max(off) over () as residual, round + 1 as round
            from {step} where residual > {TOLERANCE} and round < 100000),
        last as materialized (select *, w / tokens as ratio from rake where round = (select max(round) from rake)),
        scaled as (select *, ratio * least({FRACTION} * (select sum(tokens) from last)::double,
            (select min(tokens / w) from last)) as chance from last)
        select d.doc_id, d.source, d.lang, d.topic, d.n_tokens,
            round(coalesce(least(1.0, p.chance), 1.0), 6) as probability,
            ('0x' || substr(md5(coalesce(d.doc_id::varchar, 'null') || ':{SEED}'), 1, 8))::bigint / 4294967296.0
                < coalesce(least(1.0, p.chance), 1.0) as kept
        from docs d left join scaled p on d.source is not distinct from p.source
            and d.lang is not distinct from p.lang and d.topic is not distinct from p.topic"""
