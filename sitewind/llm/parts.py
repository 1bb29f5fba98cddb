"""Questions that parts of a table ask the whole table.

A table is written as parts of bounded size. Each part sends the distinct keys it has, packed, to
buckets of keys; a bucket sorts the keys of all parts and answers each part; a later pass over the
part reads its answers. What crosses the network is a part's distinct keys, not its rows, so a key
that a third of all rows have comes once from each part, and no task sees more than a part or a
bucket, whose number grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewind.llm.common import shared_path, staged, tasks

#: Bytes of text after which a part ends; a longer text is a part of its own.
PART_BYTES = 8 << 20


def in_parts(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(part, row, doc_id, text, n_bytes), written: text as UTF-8 bytes, empty for null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = row = TaskContext.get().partitionId() << 32
        held = 0
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            parts = np.empty(len(sizes), np.int64)
            for at, size in enumerate(sizes.tolist()):
                if held and held + size > part_bytes:
                    part, held = part + 1, 0
                held += size
                parts[at] = part
            rows = np.arange(row, row + len(sizes))
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts), pa.array(rows), *batch.columns, pa.array(sizes.astype(np.int64))],
                ["part", "row", "doc_id", "text", "n_bytes"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    schema = "part bigint, row bigint, doc_id bigint, text binary, n_bytes bigint"
    return staged(rows.mapInArrow(cut, schema), "parts")


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one part after the other, as they are stored."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        for at, end in zip(cuts, cuts[1:], strict=False):
            if at == end:
                continue
            if held and parts[at] != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = int(parts[at])
            held.append(batch.slice(at, end - at))
    if held:
        yield now, pa.Table.from_batches(held)


PACKET = "bucket bigint, part bigint, kind int, keys binary, counts binary"
ANSWER = "bucket bigint, part bigint, kind int, answer binary"


def _narrow(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _wide(packed: bytes, width: int) -> np.ndarray:
    found = np.zeros((len(packed) // width, 8), np.uint8)
    found[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return found.view("<u8").ravel()


def split_key(keys: np.ndarray, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key, and what is sent of it: the lowest bytes of the quotient. With 256 buckets
    or more, seven bytes hold all of it."""
    rest = keys // np.uint64(buckets)
    return (keys % np.uint64(buckets)).astype(np.int64), rest & np.uint64((1 << 8 * width) - 1)


def packets(
    part: int, kind: int, keys: np.ndarray, buckets: int, width: int, counts: np.ndarray | None = None
) -> pa.RecordBatch:
    """Packets of keys (uint64) by bucket, and of their counts, one number each."""
    bucket, rest = split_key(keys, buckets, width)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    rest, bucket = rest[order], bucket[order]
    counts = None if counts is None else counts[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    spans = list(zip(at.tolist(), [*at[1:].tolist(), len(keys)], strict=False))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[at], pa.int64()),
            pa.array([part] * len(spans), pa.int64()),
            pa.array([kind] * len(spans), pa.int32()),
            pa.array([_narrow(rest[a:b], width) for a, b in spans], pa.binary()),
            pa.array([b"" if counts is None else counts[a:b].tobytes() for a, b in spans], pa.binary()),
        ],
        ["bucket", "part", "kind", "keys", "counts"],
    )


def unpacked(packed: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of some packets, and where each but the first packet begins."""
    each = [_wide(p, width) for p in packed]
    return np.concatenate(each), np.cumsum([len(e) for e in each])[:-1]


def counted(width: int, values: str, summary=None):
    """For ``applyInArrow``: the total count of each key of a bucket, sent to each part that has it, as
    ``keyed`` packs them. ``summary`` (totals to bytes) is sent to part -1."""

    def answer(table: pa.Table) -> pa.Table:
        keys, cuts = unpacked(table.column("keys").to_pylist(), width)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
        distinct, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, counts, len(distinct)).astype(np.int64)
        each = zip(np.split(keys, cuts), np.split(totals[place], cuts), strict=True)
        rows = [
            (*ids, keyed(k, t, width, values))
            for ids, (k, t) in zip(zip(*(table.column(c).to_pylist() for c in ("bucket", "part", "kind")), strict=True), each, strict=True)
        ]
        if summary:
            rows.append((table.column("bucket")[0].as_py(), -1, table.column("kind")[0].as_py(), summary(totals)))
        return pa.table(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            ["bucket", "part", "kind", "answer"],
        )

    return answer


def keyed(keys: np.ndarray, found: np.ndarray, width: int, values: str) -> bytes:
    """Keys in order, then the value of each."""
    order = np.argsort(keys, kind="stable")
    return _narrow(keys[order], width) + found[order].astype(values).tobytes()


def look_up(
    keys: np.ndarray, answers: list[tuple[int, bytes]], buckets: int, width: int, values: str
) -> np.ndarray:
    """The values of these keys (uint64), all of which have been answered."""
    bucket, rest = split_key(keys, buckets, width)
    each = width + np.dtype(values).itemsize
    found = np.zeros(len(keys), values)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], [[b, b + 1] for b, _ in answers]).reshape(-1, 2)
    for (_, packed), (a, b) in zip(answers, cuts, strict=True):
        n = len(packed) // each
        known, mine = _wide(packed[: n * width], width), order[a:b]
        if n and len(mine):
            place = np.minimum(np.searchsorted(known, rest[mine]), n - 1)
            hit = known[place] == rest[mine]
            found[mine[hit]] = np.frombuffer(packed[n * width :], values)[place[hit]]
    return found


class Answers:
    """The answers to ``asked`` packets, as a table by part in the shared folder."""

    def __init__(self, answered: DataFrame, name: str) -> None:
        spark = answered.sparkSession
        self.path = shared_path(spark, name)
        answered.select("bucket", "kind", "answer", "part").repartition(tasks(spark), "part").write.partitionBy(
            "part"
        ).option("compression", "none").parquet(self.path)

    def reader(self) -> Callable[[int, int], list[tuple[int, bytes]]]:
        """A function for tasks: (part, kind) to [(bucket, answer)], by bucket."""
        path = self.path

        def read(part: int, kind: int) -> list[tuple[int, bytes]]:
            files, folder = pa.fs.FileSystem.from_uri(f"{path}/part={part}")
            found = files.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
            rows = []
            for file in found:
                if not file.path.endswith(".parquet"):
                    continue
                with files.open_input_file(file.path) as source:
                    table = pq.ParquetFile(source).read(["bucket", "kind", "answer"])
                rows += [
                    (bucket, answer)
                    for bucket, of, answer in zip(*(c.to_pylist() for c in table.columns), strict=True)
                    if of == kind
                ]
            return sorted(rows)

        return read
