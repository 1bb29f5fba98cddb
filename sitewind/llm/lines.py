"""Removing runs of lines that occur earlier, found by winnowing.

The lines of a text that have a word are hashed, whatever white space is around them. A window is the
shortest run from a line on, or up to a line, that has ``MIN_WORDS`` words; its least hash (the last
of equal ones) is a fingerprint. Equal runs of that many words have a window in common and so a
fingerprint: none is missed. Where fingerprints meet, the digests of their windows are compared, which
stands for joining and extending places: a window lies on every line of a repeated run, so those
that occur earlier overlap to runs as far as they go both ways, and the lines of those runs go.

Both kinds are needed for that: a line of a repeated run is in the window from it on, in the one up
to it, or in that from the run's first line on, and that window lies in the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm.common import documents, free_name, staged

MIN_WORDS = 50
_WHITE = " \t\n\x0b\x0c\r"


def windows(text: str) -> list[tuple[int, bytes, int, int, int]]:
    """(fingerprint, its line, digest of the window, first line, last line) of each window. Lines
    count from 0, those without a word too, but no window's digest depends on them."""
    lines = [(at, line.strip(_WHITE)) for at, line in enumerate(text.split("\n"))]
    lines = [(at, line.encode("utf-8", "surrogatepass")) for at, line in lines if line]
    words = [len(line.split()) for _, line in lines]
    hashes = [xxhash.xxh64_intdigest(line) - (1 << 63) for _, line in lines]
    places, end, held = {}, 0, 0
    for start in range(len(lines)):
        while held < MIN_WORDS and end < len(lines):
            held += words[end]
            end += 1
        if held < MIN_WORDS:
            break
        places[start, end] = None
        held -= words[start]
    start = held = 0
    for end in range(1, len(lines) + 1):
        held += words[end - 1]
        while held - words[start] >= MIN_WORDS:
            held -= words[start]
            start += 1
        if held >= MIN_WORDS:
            places[start, end] = None
    found = []
    for start, end in places:
        low = min(range(start, end), key=lambda i: (hashes[i], -i))
        digest = xxhash.xxh3_128_digest(b"\n".join(line for _, line in lines[start:end]))
        found.append((hashes[low], lines[low][0], digest, lines[start][0], lines[end - 1][0]))
    return found


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "print", "at", "digest", "first", "last"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
    for batch in batches:
        for cut in range(0, batch.num_rows, 2000):
            ids, rows, texts = (c.to_pylist() for c in batch.slice(cut, 2000).columns)
            out = [
                (i, row, *window)
                for i, row, text in zip(ids, rows, texts, strict=True)
                for window in windows(text or "")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names
            )


def _without(text: str | None, runs: list) -> str | None:
    if text is None or runs is None:
        return text
    lines = text.split("\n")
    gone = np.zeros(len(lines), bool)
    for run in runs:
        gone[run["first"] : run["last"] + 1] = True
    return "\n".join(line for line, g in zip(lines, gone, strict=True) if not g)


def _merged(runs: list | None) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in (runs if runs is not None else [])):
        if found and first <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(last, found[-1][1]))
        else:
            found.append((first, last))
    return found


def dedup_lines(docs: DataFrame, removed: str = "removed") -> DataFrame:
    """``docs`` with ``text`` without repeated runs, and in column ``removed`` the runs by first and
    last line of the old text (ARRAY<STRUCT<first, last>>; a column of that name is replaced).

    Earlier is a smaller doc_id, null ids last; of rows that repeat an id one is the earlier, and
    within a text the line further up. So of equal rows one stays whole. Null and empty texts stay
    as they are. Lines inside a removed run that have no word go with it.
    """
    names = [c for c in docs.columns if c != removed]
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)])
    of = {c: f"_{i}" for i, c in enumerate(names)}
    held = staged(rows.withColumn("row", F.monotonically_increasing_id()), "documents")

    dealt = held.select(F.col(of["doc_id"]).cast("bigint").alias("doc_id"), "row", F.col(of["text"]).alias("text"))
    found = staged(
        dealt.mapInArrow(
            _windows,
            "doc_id bigint, row bigint, print bigint, at int, digest binary, first int, last int",
        ),
        "windows",
    )
    # Places of a fingerprint are counted before they are joined. The counts are a table of their own,
    # so a fingerprint that most texts have is split in the join. Joins shuffle whatever the size.
    places = found.select("print", "row", "at").distinct()
    met = staged(places.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print"), "met")
    candidates = staged(found.join(met.hint("merge"), "print", "left_semi"), "candidates")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row", "first")
    firsts = staged(
        candidates.groupBy("digest").agg(F.min(order).alias("origin"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", F.col("origin.row").alias("origin_row"), F.col("origin.first").alias("origin_first")),
        "firsts",
    )
    later = candidates.join(firsts.hint("merge"), "digest").where("row <> origin_row or first <> origin_first")
    runs = staged(
        later.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "runs"
    )

    @F.pandas_udf("struct<text:string,removed:array<struct<first:int,last:int>>>")
    def shorten(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        merged = [_merged(r) for r in runs]
        kept = [
            _without(t, [{"first": a, "last": b} for a, b in m]) if m else t
            for t, m in zip(texts, merged, strict=True)
        ]
        return pd.DataFrame({"text": kept, "removed": [[{"first": a, "last": b} for a, b in m] for m in merged]})

    # Always shuffled: the texts are moved once, by even row numbers, however many have runs.
    found_runs = held.join(runs.hint("merge"), "row", "left").withColumn(
        "_new", shorten(F.col(of["text"]), F.col("runs"))
    )
    return found_runs.select(
        *[F.col("_new.text").alias(c) if c == "text" else F.col(of[c]).alias(c) for c in names],
        F.col("_new.removed").alias(removed),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left, and the columns it has, whatever their names."""
    return dedup_lines(docs, free_name("removed", docs.columns)).select(*docs.columns)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the number of runs and lines removed, and what is left of the text."""
    lines = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, r: s + r["last"] - r["first"] + 1)
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.size("removed").cast("bigint").alias("n_runs"),
        lines.alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
