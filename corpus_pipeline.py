"""A corpus from documents: quality rules, repeated lines, near copies, mix, tokens.

Each stage works on what the one before it kept, written as a table in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm import bpe, lines, mixing, quality, simhash
from sitewind.llm.common import documents, staged

#: SQL can't express winnowing, SimHash or the merges of a vocabulary.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occur earlier go; n_chars follows the text."""
    kept = lines.without_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay with the probabilities of their source, language and topic."""
    return mixing.sampled(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as ids, with digests of the ids and of what they decode to. The text is in the ids;
    columns that documents don't have go. Workers of the stages before still hold what they
    hold, so fewer parts are remembered."""
    coded = bpe.encoded(docs, bpe.rank_file(), remembered=120_000, at_once=4 << 20)
    return coded.select("doc_id", "lang", "source", "n_chars", "ids", *bpe.digests(coded))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("mixing", mix),
    ("byte-level bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
