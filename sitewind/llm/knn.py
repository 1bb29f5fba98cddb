"""Exact nearest vectors by inner product: a join of Voronoi cells.

Queries and vectors are grouped by their nearest pivot. The radius of a group of queries is how far
its farthest one lies from the pivot. For a vector s and a group with pivot p and radius u, every query
of the group scores between p.s - u|s| and p.s + u|s|.

A cell of vectors is cut into rings by the distance to its pivot, and a ring into blocks of bounded
size. A block is stored with its summary: the highest upper bound for each group, and the highest lower
bounds of different ids. The k-th best lower bound of all blocks is a score that each query's k-th best
reaches at least, so a block whose upper bound is below it is needed by no query of that group, and
is left out by its summary. Of the other blocks, the vectors that reach the score are sent to the
group and scored there; a group asks only the shares of the table that hold such blocks.

Where bounds can't tell (in high dimension, vectors without clusters are all about equally far from
any pivot) every block goes to every group, and the work is queries times vectors, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewind.llm.common import staged, tasks

#: Pivots: the queries with the smallest hashes of their ids. They set how much work is done only.
PIVOTS = 16
#: Queries of a group, at most about; larger ones (a third of all may be copies) are divided.
GROUP = 2048
#: Vectors that meet a group in one task, about, and vectors of a block.
SHARE = 32_768
BLOCK = 2048
#: Rings of a cell, of equal width.
RINGS = 4
SCALE = 64


def _usable(vector: Column) -> Column:
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & ~bad


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """floor(SCALE * x) of each component, rows filled up with zeros."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    found = np.zeros((len(lengths), size))
    found[np.arange(size)[None, :] < lengths[:, None]] = flat
    return found


def _packed(rows: np.ndarray, kind: str) -> list[bytes]:
    return [r.tobytes() for r in rows.astype(kind)]


def _unpacked(blobs, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(-1, size).astype(np.float64)


def _scores(queries: np.ndarray, vectors: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as int64. Where doubles can't hold them all, whole numbers of any size do, and
    what a BIGINT can't hold becomes its largest or smallest value."""
    if exact:
        return (queries @ vectors.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    found = whole(queries).dot(whole(vectors).T)
    return np.clip(found, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


_LOWS = pa.list_(pa.struct([("cell", pa.int32()), ("vec_id", pa.int64()), ("low", pa.float64())]))


def _numbers(values: np.ndarray) -> Column:
    return F.array(*[F.lit(v) for v in values.tolist()])


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one key after the other; a run that goes on in the next batch comes in two pieces."""
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for at, end in zip(cuts, cuts[1:], strict=False):
            if at < end:
                yield int(keys[at]), batch.slice(at, end - at)


def needed_blocks(blocks: DataFrame, enough: dict[int, float]) -> DataFrame:
    """A row (cell, share, ids, vectors) for each group and block that may hold one of its best. The
    bounds are plain columns, so they are held against the files before vectors are read."""
    reaches = [F.col(f"high_{c}") >= F.lit(low) for c, low in enough.items()]
    cells = F.array_compact(F.array(*[F.when(r, F.lit(c)) for r, c in zip(reaches, enough, strict=True)]))
    return blocks.where(reduce(or_, reaches)).select(
        F.explode(cells).alias("cell"),
        F.expr(f"block div {max(1, SHARE // BLOCK)}").alias("share"),
        "ids",
        "vectors",
    )


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products, as whole numbers of
    ``floor(64 * x)``, of each query with the other rows. Queries are the rows whose vec_id is
    divisible by ``every``.

    ``vectors`` has vec_id and embedding; other columns aren't read. Rows without a vec_id, without
    a vector or with a component that is null or not finite take no part. A shorter vector counts as
    filled up with zeros. Rows of the query's own vec_id are its own; a vec_id that repeats gives its
    results as often. Fewer candidates give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    vector = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & _usable(vector)
    )
    most = F.max(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))))
    n, size, largest = rows.agg(F.count(F.lit(1)), F.max(F.size(vector)), most).first()
    size, largest = max(size or 0, 1), SCALE * (largest or 0) + 1
    kind = next((t for t, top in (("<i1", 127), ("<i2", 32767), ("<i4", 2**31 - 1)) if largest <= top), "<f8")
    exact = largest * largest * size < 2**53

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = _packed(_matrix(batch.column("embedding"), size), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "vector"]
            )

    held = staged(
        rows.mapInArrow(pack, "vec_id bigint, vector binary").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "vectors",
    )
    queries = held.where(F.pmod("vec_id", F.lit(every)) == 0)
    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(PIVOTS).collect()
    result = "query bigint, query_id bigint, vec_id bigint, score bigint"
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivots = _unpacked([r.vector for r in sample], kind, size)

    # Cells of all rows, and groups of queries.
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _unpacked(batch.column("vector").to_pylist(), kind, size)
            far = np.stack([np.linalg.norm(found - p, axis=1) for p in pivots], axis=1)
            cells = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int32()), pa.array(far[np.arange(len(far)), cells])],
                ["vec_id", "vector", "row", "cell", "far"],
            )

    placed = staged(held.mapInArrow(place, "vec_id bigint, vector binary, row bigint, cell int, far double"), "cells")
    asks = F.pmod("vec_id", F.lit(every)) == 0
    widest, radius, parts = np.zeros(len(pivots)), np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for cell, far, reach, count in (
        placed.groupBy("cell").agg(F.max("far"), F.max(F.when(asks, F.col("far"))), F.count_if(asks)).collect()
    ):
        widest[cell], radius[cell], parts[cell] = far, reach or 0.0, -(-count // GROUP)

    # Blocks of cells. A vector's block follows from its row, so a task that runs again makes the same.
    ring = F.floor(F.lit(RINGS) * F.col("far") / F.get(_numbers(np.maximum(widest, 1e-300)), F.col("cell")))
    ringed = placed.withColumn("ring", (F.col("cell") * RINGS + F.least(ring, F.lit(RINGS - 1))).cast("int"))
    cuts = np.zeros(len(pivots) * RINGS, np.int64)
    for at, count in ringed.groupBy("ring").count().collect():
        cuts[at] = -(-count // BLOCK)
    first = np.cumsum(cuts) - cuts
    piece = F.pmod(F.xxhash64("row"), F.get(_numbers(np.maximum(cuts, 1)), F.col("ring")))
    n_blocks = int(cuts.sum())
    groups = [c for c in range(len(pivots)) if parts[c]]

    def bounds(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = found @ pivots.T
        spread = np.linalg.norm(found, axis=1)[:, None] * radius[None, :]
        slack = 1e-9 * (np.abs(middle) + spread + 1)
        # Scores end where BIGINT ends, and so do their bounds.
        low, high = (np.clip(b, -(2.0**63), 2.0**63) for b in (middle - spread - slack, middle + spread + slack))
        return low, high

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch in _runs(batches, "block"):
            found = _unpacked(batch.column("vector").to_pylist(), kind, size)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            low, high = bounds(found)
            lows = []
            for c in groups:
                # The best of each id: a query's own id is one of them at most, hence one more than k.
                order = np.argsort(-low[:, c], kind="stable")
                _, best = np.unique(ids[order], return_index=True)
                lows += [
                    {"cell": c, "vec_id": int(ids[at]), "low": float(low[at, c])} for at in order[np.sort(best)[: k + 1]]
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([found.astype(kind).tobytes()], pa.binary()),
                    pa.array([lows], _LOWS),
                    *(pa.array([float(high[:, c].max())]) for c in groups),
                ],
                ["block", "ids", "vectors", "lows", *(f"high_{c}" for c in groups)],
            )

    schema = "block bigint, ids binary, vectors binary, lows array<struct<cell:int,vec_id:bigint,low:double>>"
    blocks = staged(
        ringed.select("vec_id", "vector", "row", (F.get(_numbers(first), F.col("ring")) + piece).alias("block"))
        .repartition(min(tasks(spark), n_blocks), F.expr(f"block div {max(1, SHARE // BLOCK)}"))
        .sortWithinPartitions("block", "row")
        .mapInArrow(summed, ", ".join([schema, *(f"high_{c} double" for c in groups)])),
        "blocks",
    )
    order = Window.partitionBy("cell").orderBy(F.col("low").desc())
    lows = blocks.select(F.inline("lows")).groupBy("cell", "vec_id").agg(F.max("low").alias("low"))
    ranked = lows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    enough = np.full(len(pivots), -np.inf)
    for cell, count, low in ranked.groupBy("cell").agg(F.count(F.lit(1)), F.min("low")).collect():
        if count > k:
            enough[cell] = low

    # Blocks go where they are needed, and questions where blocks go.
    needed = needed_blocks(blocks, {c: float(enough[c]) for c in groups})
    of_cell = F.get(_numbers(parts), F.col("cell"))

    def for_parts(df: DataFrame) -> DataFrame:
        return df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), of_cell - 1)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                cell = row.column("cell")[0].as_py()
                found = _unpacked(row.column("vectors").to_pylist(), kind, size)
                ids = np.frombuffer(row.column("ids")[0].as_py(), "<i8")
                reach = bounds(found)[1][:, cell] >= enough[cell]
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("cell"),
                        row.column("share"),
                        pa.array([ids[reach].tobytes()], pa.binary()),
                        pa.array([found[reach].astype(kind).tobytes()], pa.binary()),
                    ],
                    ["cell", "share", "ids", "vectors"],
                )

    sent = for_parts(
        needed.select("cell", "share", "ids", "vectors").mapInArrow(
            pick, "cell int, share bigint, ids binary, vectors binary"
        )
    )

    def packed_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, batch in _runs(batches, "key"):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key % len(pivots)], pa.int32()),
                    pa.array([key // len(pivots)]),
                    pa.array([batch.column("row").to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                    pa.array([batch.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                    pa.array([b"".join(batch.column("vector").to_pylist())], pa.binary()),
                ],
                ["cell", "part", "queries", "query_ids", "wanted"],
            )

    part = F.pmod(F.xxhash64("row"), F.get(_numbers(np.maximum(parts, 1)), F.col("cell")))
    questions = (
        placed.where(asks)
        .select("vec_id", "vector", "row", (part * len(pivots) + F.col("cell")).alias("key"))
        .repartition(min(tasks(spark), int(parts.sum())), "key")
        .sortWithinPartitions("key", "row")
        .mapInArrow(packed_queries, "cell int, part bigint, queries binary, query_ids binary, wanted binary")
    )
    asked = for_parts(needed.select("cell", "share").distinct()).join(questions, ["cell", "part"])

    def solve(asked: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or sent.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query", "query_id", "vec_id", "score")})
        rows, own = (np.frombuffer(b"".join(asked[c]), "<i8") for c in ("queries", "query_ids"))
        wanted = _unpacked(asked["wanted"], kind, size)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2] * len(rows)
        for ids, vectors in zip(sent["ids"], sent["vectors"], strict=True):
            ids = np.frombuffer(ids, "<i8")
            scores = _scores(wanted, _unpacked([vectors], kind, size), exact)
            for at, row in enumerate(scores):
                other = ids != own[at]
                there, found = best[at]
                found, there = np.concatenate([found, row[other]]), np.concatenate([there, ids[other]])
                places = _best(found, there, k)
                best[at] = (there[places], found[places])
        counts = [len(b[0]) for b in best]
        return pd.DataFrame({
            "query": np.repeat(rows, counts),
            "query_id": np.repeat(own, counts),
            "vec_id": np.concatenate([b[0] for b in best]),
            "score": np.concatenate([b[1] for b in best]),
        })

    keys = ["cell", "part", "share"]
    found = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(solve, result)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best others of every 20th vector."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    """The query in SQL, every query against every vector."""
    return f"""with v as materialized (
            select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as e
            from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
            select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e)::bigint as score
            from v q join v on q.vec_id <> v.vec_id where q.vec_id % 20 = 0)
        select query_id, rank::int as rank, vec_id, score
        from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
        where rank <= 20"""
