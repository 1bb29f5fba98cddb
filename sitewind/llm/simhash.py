"""Near-duplicates by SimHash, linked at anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm import golay
from sitewind.llm.common import documents, staged, tasks
from sitewind.llm.components import components

SEED = 42
#: Bits in which linked fingerprints may differ; the anchors of ``golay`` are made for two.
DISTANCE = 2
_AT_ONCE = 1 << 16


def _simhash(text: str | None, length: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-length].tolist()] if len(words) > length else [0]
    stops = (ends[length - 1 :] - 1).tolist() or [len(whole)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(whole[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype="<u8"
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        part = hashes[at : at + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, length: int = 3) -> Column:
    """The 64-bit SimHash of the word shingles of a text, as BIGINT. A-Z count as a-z. Fewer words
    than ``length`` make one shingle; no word, an empty or a null text gives 0."""

    @F.pandas_udf("bigint")
    def simhashes(texts: pd.Series) -> pd.Series:
        return pd.Series([_simhash(t, length) for t in texts], dtype="int64")

    return simhashes(text)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            prints = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
            rows, anchors = golay.meeting_places(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.view(np.int64)), pa.array(prints[rows])], ["anchor", "print"]
            )


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(golay.homes(prints.view(np.uint64)).view(np.int64)), batch.column(0)],
            ["anchor", "home"],
        )


def links(prints: DataFrame) -> DataFrame:
    """Pairs (home, print) of different fingerprints, ``home`` the smaller one, that differ in at
    most two bits. ``prints`` has one BIGINT column of distinct values. Every pair is met once, at
    the home of its smaller one; a fingerprint has at most 2080 partners, whatever their number."""
    dealt = prints.repartition(tasks(prints.sparkSession), prints.columns[0])
    homes = dealt.mapInArrow(_homes, "anchor bigint, home bigint")
    places = dealt.mapInArrow(_places, "anchor bigint, print bigint")
    near = F.expr(f"home < print and bit_count(home ^ print) <= {DISTANCE}")
    # Always shuffled: a fingerprint has some 58 places, which Spark sizes like the fingerprints.
    return homes.join(places.hint("merge"), "anchor").where(near).select("home", "print")


def near_duplicates(docs: DataFrame, length: int = 3) -> DataFrame:
    """One row (doc_id, print, component_id) per row of ``docs``; other columns aren't read.

    ``component_id`` is the smallest doc_id that links lead to, null if all of them are null. Copies
    share one fingerprint and are linked as one. Rows that repeat are kept as often as they come.
    """
    rows = staged(docs.select("doc_id", fingerprint(F.col("text"), length).alias("print")), "prints")
    by_print = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    found = components(links(by_print.select("print"))).withColumnRenamed("node", "print")
    # Tables with a row per fingerprint are shuffled: as files they are far smaller than when broadcast.
    labelled = by_print.join(found.hint("merge"), "print", "left").withColumn(
        "component", F.coalesce("component", "print")
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = staged(labelled.join(least.hint("merge"), "component").select("print", "component_id"), "labels")
    return rows.join(labels.hint("merge"), "print").select("doc_id", "print", "component_id")


def one_of_each(docs: DataFrame, length: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: one of its smallest doc_id, the first
    of them if several rows have it or none has an id. All columns stay."""
    names = docs.columns
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)]).withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "print": fingerprint(F.col(f"_{names.index('text')}"), length),
        }
    )
    held = staged(rows, "documents")
    prints = held.select(F.col(f"_{names.index('doc_id')}").alias("doc_id"), "row", "print")
    found = components(links(prints.select("print").distinct())).withColumnRenamed("node", "print")
    labels = staged(found, "labels")
    labelled = prints.join(labels.hint("merge"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = staged(labelled.groupBy("component").agg(first.alias("first")).select("first.row"), "kept")
    # Always shuffled: the texts are moved once, by even row numbers, however many groups there are.
    return held.join(kept.hint("merge"), "row", "left_semi").select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(names)]
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their fingerprint and the smallest doc_id of their group."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
