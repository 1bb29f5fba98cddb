"""Connected components of links, by alternating stars.

Each round joins links to the least neighbour of their ends, so no component is ever gathered in
one task; a node with most links is pre-aggregated, and its joins are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewind.llm.common import staged

#: Links from which on their least neighbours are shuffled and not broadcast. Spark goes by the size of
#: the links' files, which may hold an id in a byte or two.
MANY = 1 << 17


def _large_star(links: DataFrame, many: bool) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    both = both.toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.where("other > node")
        .join(least.hint("merge") if many else least, "node")
        .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame, many: bool) -> DataFrame:
    """A node and its neighbours below are linked to the least of those neighbours."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(least.hint("merge") if many else least, "high").where("low > least").select(
        F.col("low").alias("high"), F.col("least").alias("low")
    )
    return moved.union(least.select("high", F.col("least").alias("low"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (two columns of one type, nulls and loops
    left out): the component is its least node. No links, no rows."""
    links = links.toDF("a", "b").where("a <> b")
    links = staged(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        many = state[0] >= MANY
        links = staged(_small_star(_large_star(links, many), many), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        links.select("low", "low").distinct()
    )
