"""Quality rules whose thresholds follow each language and source.

Each document is measured once. A quantile sketch per language, source and signal counts its values
in cells of bounded relative width; sketches merge by adding counts, so they are made by partial
sums, whatever one source holds, and do not depend on the order of rows or merges. Thresholds are
fences set from quartiles of the sketches and joined to the documents.

Everything is a column expression, so it runs inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm.common import WORD_CLASS, documents, free_name, let, staged, text_or_empty, word_array

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

#: A cell of a sketch is at most 2**-CELL_BITS of its values wide.
CELL_BITS = 6
#: Fences stand this many spreads from the outer quartiles.
REACH = 6
#: Rates over few words scatter more: with this many words twice as far is allowed.
FEW_WORDS = 30
#: Documents a group of language and source needs for thresholds of its own; smaller ones take those
#: of the language, and then those of all documents.
LEAST_DOCUMENTS = 100

#: Signal: (sides on which it is judged, least spread). All are whole numbers: a word's mean length
#: in hundredths of characters, the others per thousand words or lines.
SIGNALS = {
    "word_length": ("both", 60),
    "symbol_rate": ("high", 25),
    "repeated_line_rate": ("high", 70),
    "repeated_word_rate": ("high", 35),
}


def _dup_lines(text: Column) -> Column:
    # Asked for a character of a word: an end of line in Java's sense may stand before other marks.
    return let(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CLASS)),
        lambda lines: F.struct(
            F.size(lines).cast("bigint").alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("dup"),
        ),
    )


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that come twice or more. A window is known by its 64-bit hash."""
    n = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(1), n - WINDOW + 1),
        lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(WINDOW)]),
    )

    def covered(places: Column) -> Column:
        """Words covered by windows that begin at these places, which ascend."""
        step = F.aggregate(
            places,
            F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-WINDOW).alias("last")),
            lambda s, p: F.struct(
                (s["sum"] + F.least(F.lit(WINDOW), p - s["last"])).alias("sum"), p.alias("last")
            ),
        )
        return step["sum"]

    def repeated_places(hashes: Column) -> Column:
        # Sorted by hash, then place: windows that come twice stand side by side.
        ordered = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
        )
        return let(
            ordered,
            lambda rows: F.array_sort(
                F.transform(
                    F.filter(
                        rows,
                        lambda r, i: (F.get(rows, i - 1)["hash"] == r["hash"])
                        | (F.get(rows, i + 1)["hash"] == r["hash"]),
                    ),
                    lambda r: r["place"],
                )
            ),
        )

    none = F.lit(0).cast("bigint")
    return F.when(n < WINDOW + 1, none).otherwise(
        let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(
                covered(repeated_places(h))
            ),
        )
    )


def measures(text: Column) -> Column:
    """STRUCT of n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words;
    all 0 for a null text."""

    return let(
        F.struct(word_array(text).alias("words"), _dup_lines(text).alias("lines")),
        lambda x: F.struct(
            F.size(x["words"]).cast("bigint").alias("n_words"),
            F.length(F.array_join(x["words"], "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
            x["lines"]["n"].alias("n_lines"),
            x["lines"]["dup"].alias("n_dup_lines"),
            _repeat_words(x["words"]).alias("n_repeat_words"),
        ),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def signals(m: Column) -> dict[str, Column]:
    def rate(part: str, of: str, scale: int) -> Column:
        whole = m[part] * scale
        return F.when(m[of] > 0, F.call_function("div", whole, m[of])).otherwise(0).cast("bigint")

    return {
        "word_length": rate("word_chars", "n_words", 100),
        "symbol_rate": rate("n_symbols", "n_words", 1000),
        "repeated_line_rate": rate("n_dup_lines", "n_lines", 1000),
        "repeated_word_rate": rate("n_repeat_words", "n_words", 1000),
    }


def cell(value: Column) -> Column:
    """Lower end of the sketch's cell of a whole number from 0: its first binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - (CELL_BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Counts by group, signal and cell. Two sketches merge by adding their counts."""
    return (
        measured.select(
            *groups,
            F.explode(
                F.array(*[F.struct(F.lit(s).alias("signal"), cell(F.col(s)).alias("cell")) for s in SIGNALS])
            ).alias("x"),
        )
        .groupBy(*groups, "x.signal", "x.cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(parts: DataFrame, groups: list[str]) -> DataFrame:
    return parts.groupBy(*groups, "signal", "cell").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, signal, n, q1, q3, reach): quartiles of each sketch, and how far from them is too far.

    A sketch has at most 64 cells for each binary digit of its values, so it is a bounded array.
    """
    cells = sketch.groupBy(*groups, "signal").agg(
        F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells"), F.sum("n").alias("n")
    )

    def quantile(parts: int) -> Column:
        # The least cell up to which lie at least parts/4 of the values.
        found = F.aggregate(
            "cells",
            F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at")),
            lambda s, c: F.struct(
                (s["seen"] + c["n"]).alias("seen"),
                F.when(s["at"].isNull() & (4 * (s["seen"] + c["n"]) >= parts * F.col("n")), c["cell"])
                .otherwise(s["at"]).alias("at"),
            ),
        )
        return found["at"]

    least = F.create_map(*[F.lit(x) for s, (_, spread) in SIGNALS.items() for x in (s, spread)])
    quartiles = cells.select(*groups, "signal", "n", quantile(1).alias("q1"), quantile(3).alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("signal")])
    return quartiles.withColumn("reach", REACH * spread)


def _wide(fences: DataFrame, groups: list[str], prefix: str) -> DataFrame:
    """One row per group: a map from signal to its fences, and the number of documents."""
    return fences.groupBy(*groups).agg(
        F.map_from_entries(
            F.collect_list(F.struct("signal", F.struct("q1", "q3", "reach")))
        ).alias(f"{prefix}_fences"),
        F.max("n").alias(f"{prefix}_n"),
    )


def judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, its measures, base_failed and kept.

    A null language or source is a group like any other. A null or empty text has no word and fails
    the base rules. Rows that repeat are judged alike. Other columns than ``keep``, lang, source and
    text aren't read, so their names may be any. A column of the result whose name is in ``keep``
    has `q_` in front of it.
    """
    m = F.col("_m")
    groups = ["_lang", "_source"]
    rows = docs.select(
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
        F.col("lang").cast("string").alias("_lang"),
        F.col("source").cast("string").alias("_source"),
        measures(text_or_empty()).alias("_m"),
    )
    rows = rows.select(
        "*",
        *[value.alias(name) for name, value in signals(m).items()],
        base_failed(m["n_words"], m["n_repeat_words"]).alias("base_failed"),
    )
    measured = staged(rows, "measured")

    parts = sketches(measured.where("not base_failed"), groups)
    by_lang = merged(parts, ["_lang"])
    # As tables their size is known, so small ones are broadcast and the documents stay in place.
    of_source = staged(_wide(fences(parts, groups), groups, "source"), "fences")
    of_lang = staged(_wide(fences(by_lang, ["_lang"]), ["_lang"], "lang"), "fences")
    of_all = _wide(fences(merged(by_lang, []), []), [], "all")

    same_lang = F.col("_lang").eqNullSafe(F.col("_lang_l"))
    same_source = F.col("_lang").eqNullSafe(F.col("_lang_s")) & F.col("_source").eqNullSafe(F.col("_source_s"))
    joined = measured.join(
        of_source.withColumnsRenamed({"_lang": "_lang_s", "_source": "_source_s"}), same_source, "left"
    ).join(of_lang.withColumnRenamed("_lang", "_lang_l"), same_lang, "left")
    # One row, as a scalar subquery would give.
    chosen = F.when(F.col("source_n") >= LEAST_DOCUMENTS, F.col("source_fences")).when(
        F.col("lang_n") >= LEAST_DOCUMENTS, F.col("lang_fences")
    ).otherwise(of_all.select("all_fences").scalar())
    decided = joined.withColumn("_fences", chosen)

    def outside(signal: str, sides: str) -> Column:
        fence = F.col("_fences")[signal]
        n = m["n_words"]
        beyond = F.col(signal) - fence["q3"]
        if sides == "both":
            beyond = F.greatest(beyond, fence["q1"] - F.col(signal))
        return beyond * n > fence["reach"] * (n + FEW_WORDS)

    broken = F.lit(False)
    for signal, (sides, _) in SIGNALS.items():
        broken = broken | F.coalesce(outside(signal, sides), F.lit(False))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    found = {
        **{name: m[name] for name in names},
        "base_failed": F.col("base_failed"),
        "kept": ~F.col("base_failed") & ~broken,
        **{name: F.col(name) for name in SIGNALS},
    }
    return decided.select(
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        *[value.alias(free_name(name, keep)) for name, value in found.items()],
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they have, whatever their names."""
    kept = free_name("kept", docs.columns)
    return judged(docs, docs.columns).where(F.col(kept)).select(*docs.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their measures, the verdict of the base rules and that of the thresholds."""
    return judged(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", *SIGNALS,
    )


def oracle() -> str:
    """The query in SQL, with windows as text and cells sorted and summed."""
    spread = " ".join(f"when '{name}' then {least}" for name, (_, least) in SIGNALS.items())
    cells = " union all ".join(
        f"""select lang, source, '{name}' as signal,
            ({name} >> greatest(length(bin({name})) - {CELL_BITS + 1}, 0)::int)
                << greatest(length(bin({name})) - {CELL_BITS + 1}, 0)::int as cell
            from s where not base_failed"""
        for name in SIGNALS
    )

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name} as materialized (
            select {by}signal, max(total) as n, min(case when 4 * seen >= total then cell end) as q1,
                min(case when 4 * seen >= 3 * total then cell end) as q3
            from (select *, sum(n) over (partition by {by}signal order by cell) as seen,
                    sum(n) over (partition by {by}signal) as total
                  from (select {by}signal, cell, count(*) as n from cells group by all))
            group by {by}signal)"""

    broken = " or ".join(
        f"""(f.signal = '{name}' and ({
            f'greatest({name} - q3, q1 - {name})' if sides == 'both' else f'{name} - q3'
        }) * n_words > {REACH} * greatest(q3 - q1, spread) * (n_words + {FEW_WORDS}))"""
        for name, (sides, _) in SIGNALS.items()
    )
    rates = """case when n_words > 0 then 100 * word_chars // n_words else 0 end as word_length,
        case when n_words > 0 then 1000 * n_symbols // n_words else 0 end as symbol_rate,
        case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as repeated_line_rate,
        case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeated_word_rate"""
    return f"""with w as materialized (
            select row_number() over () as row, doc_id, lang, source, t,
                regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as words,
                list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
            from (select doc_id, lang, source, coalesce(text, '') as t from documents)),
        windows as (
            select row, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as window_text
            from (select row, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) as i from w)),
        repeated as (
            select row, i from (select *, count(*) over (partition by row, window_text) as n from windows)
            where n > 1),
        covered as (
            select row, count(distinct i + k) as n
            from (select row, i, unnest(range({WINDOW})) as k from repeated) group by row),
        m as materialized (
            select w.row, doc_id, lang, source, len(words)::bigint as n_words,
                coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
                length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g'))::bigint as n_symbols,
                len(lines)::bigint as n_lines,
                (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
                coalesce(n, 0)::bigint as n_repeat_words
            from w left join covered on covered.row = w.row),
        s as materialized (
            select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed,
                {rates} from m),
        cells as materialized ({cells}),
        {level('by_source', 'lang, source')}, {level('by_lang', 'lang')}, {level('by_all', '')},
        chosen as (
            select s.row, a.signal, case a.signal {spread} end as spread,
                case when x.n >= {LEAST_DOCUMENTS} then x.q1 when l.n >= {LEAST_DOCUMENTS} then l.q1 else a.q1 end as q1,
                case when x.n >= {LEAST_DOCUMENTS} then x.q3 when l.n >= {LEAST_DOCUMENTS} then l.q3 else a.q3 end as q3
            from s cross join by_all a
            left join by_source x on x.signal = a.signal and x.lang is not distinct from s.lang
                and x.source is not distinct from s.source
            left join by_lang l on l.signal = a.signal and l.lang is not distinct from s.lang),
        broken as (select distinct s.row from s join chosen f on f.row = s.row where {broken})
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not base_failed and s.row not in (select row from broken) as kept, {", ".join(SIGNALS)}
        from s"""
