"""Queries of the subpackage, and their counterparts in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitewind.llm import alignment, bpe, ctw, divergence, knn, lines, mixing, quality, secrets, sequences, shingles, simhash, substrings


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        quality.op1_quality_rules,
        sequences.op2_token_files,
        ctw.op3_ctw_score,
        lines.op4_line_dedup,
        mixing.op5_mix_to_targets,
        substrings.op6_suffix_dedup,
        knn.op7_voronoi_knn,
        bpe.op8_byte_bpe,
        secrets.op9_secret_scan,
        simhash.op10_simhash_near_dedup,
        shingles.op11_ngram_jaccard,
        divergence.op12_source_divergence,
        alignment.op13_token_alignment,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality.oracle(),
        "op5_mix_to_targets": mixing.oracle(),
        "op7_voronoi_knn": knn.oracle(),
        "op12_source_divergence": divergence.oracle(),
    }
