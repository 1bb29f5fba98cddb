"""Running totals over an order, without bringing the rows or a group of them to one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values of the first column of the order that share a bucket, and of the second that share a piece.
WIDTH = 4096


def _same(names: Sequence[str], other: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"{other}{name}")) for name in names]
    )


def _with(df: DataFrame, other: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    """``df`` with the other columns of ``other``, by equal names; NULL is a value like any other."""
    renamed = other.select(
        *[F.col(name).alias(f"{prefix}{name}") if name in names else name for name in other.columns]
    )
    return df.join(renamed, _same(names, prefix)).drop(*[f"{prefix}{name}" for name in names])


def _before(totals: DataFrame, within: Sequence[str], order: str, name: str) -> DataFrame:
    """``totals`` with the sum of column ``total`` before each row."""
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum("_total").over(earlier), F.lit(0)))


def running_total(
    df: DataFrame,
    order: Sequence[str],
    weight: Column,
    name: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add the total ``weight`` of the rows before each row, as BIGINT column ``name``.

    ``order`` must tell all rows apart. ``within`` restarts the total for each value of those
    columns, which have to lead ``order``; NULL is a value like any other. The column after them is
    a BIGINT, and so is the next, if there is one.

    Which bucket a row is in follows from its own values, so nothing is sampled or counted first, and
    rows that are read again are in the same place. A bucket has ``WIDTH`` values of the first
    column. If there is a second one, a bucket may have any number of rows, and is cut into pieces
    of one value of the first column and ``WIDTH`` of the second. Only totals are carried on, from
    piece to piece and from bucket to bucket: one row per bucket is what the last step sorts, and a
    group of any size is worked on by as many tasks as it has pieces.
    """
    if list(order[: len(within)]) != list(within):
        raise ValueError("the columns of 'within' must lead 'order'")
    first, *rest = order[len(within):]
    bucket = [*within, "_bucket"]
    # Division cuts off towards zero: on both sides of it would be one bucket.
    at = F.call_function("div", F.col(first), F.lit(WIDTH)) - F.when(F.col(first) < 0, 1).otherwise(0)
    rows = df.withColumns({"_weight": weight.cast("bigint"), "_bucket": at})
    piece = list(bucket)
    if rest:
        second = F.floor(F.col(rest[0]) / F.lit(WIDTH)) if dict(df.dtypes)[rest[0]] == "bigint" else F.lit(0).cast("bigint")
        rows = rows.withColumn("_piece", F.struct(F.col(first).cast("bigint").alias("a"), second.alias("b")))
        piece.append("_piece")

    totals = rows.groupBy(*piece).agg(F.sum("_weight").alias("_total"))
    sums = totals.groupBy(*bucket).agg(F.sum("_total").alias("_total")) if rest else totals
    offsets = _before(sums, within, "_bucket", "_offset").drop("_total")
    if rest:
        ahead = _before(totals, bucket, "_piece", "_ahead").drop("_total")
        offsets = _with(ahead, offsets, bucket, "_of_").withColumn("_offset", F.col("_offset") + F.col("_ahead"))
        offsets = offsets.drop("_ahead")

    inside = Window.partitionBy(*piece).orderBy(first, *rest).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = rows.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return _with(placed, offsets, piece, "_at_").select(
        *df.columns, (F.col("_offset") + F.col("_inside")).alias(name)
    )
