"""Token ids in binary files that give any sequence without decoding.

Documents are sorted by ``doc_id``, encoded, and laid one after the other. Each task writes its range
as one Arrow file of sequences of equal length, a fixed-size list of ids and one of mask bits, in
batches of equal size; the last sequence of a file is filled up with zeros under a mask of false.
So the place of any token follows from its number, and a reader maps the file and slices it.

The table of places is the manifest: it names the files of the tasks that ended well, and what a
lost executor had begun is in no row of it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitewind.llm.common import documents, shared_path, slices, staged, tasks
from sitewind.llm.wordcodes import REMEMBERED, Coded, Memory, Vocabulary, gathered

#: Tokens of a sequence, sequences of a batch.
LENGTH = 2048
BATCH = 128
#: Bytes of text that are encoded at once.
TEXT_AT_ONCE = 8 << 20


def byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others for those from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def byte_level(tokenizer: str) -> tuple[Tokenizer, Vocabulary]:
    """The library of a tokenizer file, for which special tokens are plain text, and its vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_str(tokenizer)
    library.encode_special_tokens = True
    byte = {c: b for b, c in byte_characters().items()}
    spelled = [b""] * library.get_vocab_size()
    for token, at in library.get_vocab().items():
        spelled[at] = bytes(byte[c] for c in token)

    def encode(texts: list[str]) -> list:
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    return library, Vocabulary(encode, spelled)


class _Encoder:
    """Ids of texts, as the library's ``encode(text, add_special_tokens=False)`` has them. Texts that hold
    one of the file's added tokens go to the library whole, as it looks for those before any cut."""

    def __init__(self, tokenizer: str) -> None:
        self.library = Tokenizer.from_str(tokenizer)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        _, vocabulary = byte_level(tokenizer)
        self.encode = vocabulary.encode
        self.memory = Memory([vocabulary])
        self.first: dict[str, np.ndarray] = {}

    def _first_parts(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of parts that begin a text: no space is in front of them."""
        if len(self.first) > REMEMBERED:
            self.first = {}
        new = [p for p in dict.fromkeys(parts) if p not in self.first]
        self.first |= zip(new, [np.array(ids, np.int32) for ids in self.encode(new)] if new else [], strict=True)
        return [self.first[p] for p in parts]

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        places, ends = self.memory.places(texts)
        begins = np.concatenate([[0], ends[:-1]])
        first = self._first_parts([self.memory.parts[p] for p in places[begins].tolist()])
        coded = self.memory.coded[0]
        sizes = np.array([len(f) for f in first], np.int64)
        both = Coded(
            np.concatenate([coded.ids, *first]),
            np.concatenate([coded.ends, len(coded.ids) + np.cumsum(sizes)]), coded.exact,
        )
        places = places.copy()
        places[begins] = len(coded.ends) + np.arange(len(begins))
        ids, stops = gathered(both, places)
        found = np.split(ids, stops[ends[:-1] - 1]) if len(ends) > 1 else [ids]
        for token in self.added:
            for at in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)).tolist():
                found[at] = np.array(self.library.encode(texts[at].as_py(), add_special_tokens=False).ids, np.int32)
        return found


@cache
def _encoder(tokenizer: str) -> _Encoder:
    return _Encoder(tokenizer)


def id_type(tokenizer_file: str) -> pa.DataType:
    """Two bytes an id where the vocabulary allows it, else four."""
    return pa.uint16() if Tokenizer.from_str(tokenizer_file).get_vocab_size() <= 1 << 16 else pa.uint32()


def file_schema(ids: pa.DataType, length: int = LENGTH) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Writer:
    """One file; holds at most a batch of tokens and a document."""

    def __init__(self, uri: str, ids: pa.DataType, length: int, batch: int) -> None:
        files, path = pa.fs.FileSystem.from_uri(uri)
        self.schema, self.length, self.size = file_schema(ids, length), length, length * batch
        self.type = ids.to_pandas_dtype()
        self.sink = files.open_output_stream(path)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.written = 0

    def add(self, ids: np.ndarray) -> int:
        start = self.written + self.held
        self.waiting.append(ids.astype(self.type))
        self.held += len(ids)
        if self.held >= self.size:
            whole = np.concatenate(self.waiting)
            full = len(whole) // self.size * self.size
            for at in range(0, full, self.size):
                self._write(whole[at : at + self.size], self.size)
            self.waiting, self.held = [whole[full:]], len(whole) - full
            self.written += full
        return start

    def _write(self, ids: np.ndarray, valid: int) -> None:
        mask = pa.array(np.arange(len(ids)) < valid)
        self.file.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(ids), mask)],
            schema=self.schema,
        ))

    def close(self) -> None:
        if self.held:
            rest = np.concatenate(self.waiting)
            filled = np.zeros(-(-len(rest) // self.length) * self.length, self.type)
            filled[: len(rest)] = rest
            self._write(filled, len(rest))
        self.file.close()
        self.sink.close()


def write_sequences(
    docs: DataFrame, folder: str, tokenizer_file: str, end: int = 2, length: int = LENGTH, batch: int = BATCH
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text; others aren't read) under ``folder``, a URI that all
    executors reach, and return the manifest: doc_id, file, part (files in order), begin (token of
    the file), n_tokens, start (tokens of all documents before).

    Each document ends with the id ``end``; a null or empty text has that one alone. Null ids come
    first; documents of one id come in an order of their texts, and equal rows as often as they are.
    """
    spark = docs.sparkSession
    ids = id_type(tokenizer_file)
    shared = spark.sparkContext.broadcast(tokenizer_file)
    last = np.array([end], np.int32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, writer = _encoder(shared.value), TaskContext.get(), None
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        for rows in batches:
            for some in slices(rows, "_text", TEXT_AT_ONCE):
                begins, sizes = [], []
                writer = writer or _Writer(f"{folder}/{name}", ids, length, batch)
                for code in encoder.texts(some.column("_text")):
                    tokens = np.concatenate([code, last])
                    begins.append(writer.add(tokens))
                    sizes.append(len(tokens))
                n = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array([name] * n), pa.array([task.partitionId()] * n),
                     pa.array(begins, pa.int64()), pa.array(sizes, pa.int64())],
                    ["doc_id", "file", "part", "begin", "n_tokens"],
                )
        if writer:
            writer.close()

    files, path = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie"), F.col("_row")]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("_text"),
        F.xxhash64("text").alias("_tie"),
        F.monotonically_increasing_id().alias("_row"),
    )
    dealt = rows.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    manifest = staged(
        dealt.mapInArrow(write, "doc_id bigint, file string, part bigint, begin bigint, n_tokens bigint"),
        "manifest",
    )
    # One row per file.
    sizes = manifest.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return manifest.join(offsets, "part").withColumn("start", F.col("offset") + F.col("begin")).drop("offset")


@lru_cache(maxsize=2)
def _opened(uri: str) -> pa.RecordBatchFileReader:
    files, path = pa.fs.FileSystem.from_uri(uri)
    if isinstance(files, pa.fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(path))
    return pa.ipc.open_file(files.open_input_file(path))


def tokens(uri: str, begin: int, count: int, length: int = LENGTH, batch: int = BATCH) -> np.ndarray:
    """Tokens ``begin`` to ``begin + count`` of a file: a view of it, unless they lie in several
    batches."""
    file, size, parts = _opened(uri), length * batch, []
    for at in range(begin // size, -(-(begin + count) // size)):
        flat = file.get_batch(at).column(0).flatten().to_numpy()
        parts.append(flat[max(begin - at * size, 0) : begin + count - at * size])
    return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def read_documents(manifest: DataFrame, folder: str, length: int = LENGTH, batch: int = BATCH) -> DataFrame:
    """The manifest with the ids of each document, read from the files, as little-endian unsigned
    32-bit integers (``ids``, BINARY)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, 1000):
                some = rows.slice(at, 1000)
                places = zip(*(some.column(c).to_pylist() for c in ("file", "begin", "n_tokens")), strict=True)
                ids = [
                    tokens(f"{folder}/{file}", begin, count, length, batch).astype("<u4").tobytes()
                    for file, begin, count in places
                ]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(ids, pa.binary())], [*some.schema.names, "ids"]
                )

    wanted = manifest.select("doc_id", "file", "part", "begin", "n_tokens", "start")
    dealt = wanted.repartition(tasks(manifest.sparkSession), "part").sortWithinPartitions("part", "begin")
    schema = ", ".join(f"{name} {kind}" for name, kind in wanted.dtypes)
    return dealt.mapInArrow(read, f"{schema}, ids binary")


def read_sequences(spark: SparkSession, manifest: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """All sequences: file, sequence (its number in the file), ids (ARRAY<INT>), mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name in rows.column(0).to_pylist():
                file, number = _opened(f"{folder}/{name}"), 0
                for at in range(file.num_record_batches):
                    part = file.get_batch(at)
                    flat = part.column(0).flatten().cast(pa.int32())
                    ends = pa.array(np.arange(0, len(flat) + 1, length, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * part.num_rows),
                         pa.array(np.arange(number, number + part.num_rows)),
                         pa.ListArray.from_arrays(ends, flat),
                         pa.ListArray.from_arrays(ends, part.column(1).flatten())],
                        ["file", "sequence", "ids", "mask"],
                    )
                    number += part.num_rows

    files = manifest.select("file").distinct().repartition(tasks(spark), "file")
    return files.mapInArrow(read, "file string, sequence bigint, ids array<int>, mask array<boolean>")


def tokenizer_file(path: str | None = None) -> str:
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the place and the checksum of their ids, as read back from the files."""
    folder = shared_path(spark, "sequences")
    manifest = write_sequences(documents(spark, sf_dir), folder, tokenizer_file())
    return read_documents(manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
