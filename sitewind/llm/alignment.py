"""Two vocabularies' tokens of the same texts, aligned by the bytes they cover.

Both vocabularies code a batch of texts. An as-of merge on where tokens start, keyed by document, gives
each token of one side the token of the other side that covers its start; the merges of both directions
together are all pairs that overlap. Where two tokens start at one place, a group of tokens
begins: there all tokens before end on both sides.

In how many documents a pair of ids is linked is counted over all documents; what a part of the table
asks for is its distinct pairs, and these are what is sent back to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from sitewind.llm.common import documents, slices, staged
from sitewind.llm.sequences import byte_level, tokenizer_file
from sitewind.llm.wordcodes import Memory, Vocabulary, gathered

#: Bytes of text that are coded at once, words that are merged at once, and bytes of text of a part.
TEXT_AT_ONCE = 4 << 20
WORDS_AT_ONCE = 600_000
PART_BYTES = 32 << 20

_LINKED = (
    "part bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<int>"
)
_RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def pieces(model: bytes) -> Vocabulary:
    """The vocabulary of a piece model, which puts a space before each text by itself."""
    library = SentencePieceProcessor(model_proto=model)
    spelled = [
        bytes([int(p[3:5], 16)]) if library.is_byte(at) else p.replace("▁", " ").encode()
        for at in range(library.get_piece_size())
        for p in [library.id_to_piece(at)]
    ]
    return Vocabulary(lambda texts: library.encode([t[1:] for t in texts], num_threads=1), spelled)


@dataclass
class _Aligned:
    """Tokens of some texts: ids, the texts they are of, whether they begin a group, and the links, as
    places of tokens."""

    ids: tuple[np.ndarray, np.ndarray]
    of: tuple[np.ndarray, np.ndarray]
    begins: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]


def align(
    ids: tuple[np.ndarray, np.ndarray], of: tuple[np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray]
) -> _Aligned:
    """Tokens of both sides, by the text they are of (in order) and by their sizes in bytes; both
    sides of a text have equally many bytes."""
    starts = tuple(np.cumsum(s) - s for s in sizes)
    sides = [
        pd.DataFrame({"doc": d, "start": s, name: np.arange(len(s))})
        for d, s, name in zip(of, starts, "ab", strict=True)
    ]
    # The places of a batch follow one another, so they are sorted, as the merge wants them.
    for_a = pd.merge_asof(sides[0], sides[1], on="start", by="doc")["b"].to_numpy()
    for_b = pd.merge_asof(sides[1], sides[0], on="start", by="doc")["a"].to_numpy()
    begins = (starts[1][for_a] == starts[0], starts[0][for_b] == starts[1])
    more = np.flatnonzero(~begins[1])
    links = (
        np.concatenate([np.arange(len(for_a)), for_b[more]]),
        np.concatenate([for_a, more]),
    )
    return _Aligned(ids, of, begins, links)


def written(found: _Aligned, words: pa.Array, sizes: list[int], n: int) -> pa.Array:
    """The groups of each of ``n`` texts as `a1,a2|b1;a3|b2;`, each group ended. ``words`` has, for
    each side, the decimal of each id before a comma, then all of them before the end of a side; the
    sides have ``sizes`` ids."""
    group = [np.cumsum(b) - 1 for b in found.begins]
    firsts = [np.flatnonzero(b) for b in found.begins]
    last = []
    for begins in found.begins:
        ends = np.ones(len(begins), bool)
        ends[:-1] = begins[1:]
        last.append(ends)
    # Of a group, all tokens of a side come after those of the other side in the groups before, and
    # the second side's after the first's in this one, too.
    nexts = np.append(firsts[0][1:], len(group[0]))
    at = [np.arange(len(group[0])) + firsts[1][group[0]], np.arange(len(group[1])) + nexts[group[1]]]
    code = np.empty(len(at[0]) + len(at[1]), np.int64)
    code[at[0]] = found.ids[0] + np.where(last[0], sizes[0], 0)
    code[at[1]] = found.ids[1] + np.where(last[1], sizes[1], 0) + 2 * sizes[0]
    counts = np.bincount(found.of[0], minlength=n) + np.bincount(found.of[1], minlength=n)
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    lists = pa.ListArray.from_arrays(ends, words.take(pa.array(code)))
    return pc.binary_join(lists, "")


def _spell(size: int, end: str) -> pa.Array:
    return pa.array([f"{i}," for i in range(size)] + [f"{i}{end}" for i in range(size)])


class _Aligner:
    """Both vocabularies in a worker."""

    def __init__(self, tokenizer: str, model: bytes) -> None:
        self.sides = (byte_level(tokenizer)[1], pieces(model))
        self.memory = Memory(list(self.sides))
        self.sizes = [len(v.sizes) for v in self.sides]
        self.words = pa.concat_arrays([_spell(n, end) for n, end in zip(self.sizes, "|;", strict=True)])
        self.width = self.sizes[1]

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, _Aligned, list[str], np.ndarray]]:
        """Some texts at a time: (the first of them, their alignment, their groups, their pairs), the
        last text of one may be the first of the next, whose tokens go on."""
        places, ends = self.memory.places(texts.fill_null(""))
        exact = self.memory.coded[0].exact & self.memory.coded[1].exact
        of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        good = np.ones(len(ends), bool)
        good[of[~exact[places]]] = False
        good[pc.equal(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False)] = False
        used = good[of]
        places, of = places[used], of[used]
        for at in range(0, len(places), WORDS_AT_ONCE):
            some, text = places[at : at + WORDS_AT_ONCE], of[at : at + WORDS_AT_ONCE]
            first = int(text[0])
            ids, mine, sizes = [], [], []
            for vocabulary, coded in zip(self.sides, self.memory.coded, strict=True):
                code, stops = gathered(coded, some)
                ids.append(code)
                mine.append(np.repeat(text - first, np.diff(stops, prepend=0)))
                sizes.append(vocabulary.sizes[code])
            found = align(tuple(ids), tuple(mine), tuple(sizes))
            pairs = found.ids[0][found.links[0]].astype(np.int64) * self.width + found.ids[1][found.links[1]]
            yield first, found, written(found, self.words, self.sizes, int(text[-1]) - first + 1).to_pylist(), pairs


@cache
def _aligner(tokenizer: str, model: bytes) -> _Aligner:
    return _Aligner(tokenizer, model)


@dataclass
class _Document:
    """What is known of a document so far."""

    n: np.ndarray
    digest: object
    groups: list[str]
    pairs: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def new(cls) -> _Document:
        return cls(np.zeros(4, np.int64), hashlib.sha256(), [], [], [])

    def add(self, n: np.ndarray, groups: str, pairs: np.ndarray, times: np.ndarray, keep: bool) -> None:
        if keep:
            self.groups.append(groups)
        # A group ends with a mark that isn't wanted after the last one.
        self.digest.update((";" if self.n[0] else "").encode() + groups[:-1].encode())
        self.n += n
        self.pairs.append(pairs)
        self.times.append(times)

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0], self.times[0]
        pairs, place = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]), return_inverse=True)
        times = np.bincount(place, np.concatenate([np.zeros(0), *self.times]), len(pairs))
        return pairs, times.astype(np.int64)


def _documents(aligner: _Aligner, texts: pa.Array, keep: bool = False) -> list[_Document]:
    found = [_Document.new() for _ in range(len(texts))]
    for first, aligned, groups, pairs in aligner.texts(texts):
        n = len(groups)
        of = aligned.of[0][aligned.links[0]]
        counts = np.stack([
            np.bincount(aligned.of[0], minlength=n), np.bincount(aligned.of[1], minlength=n),
            np.bincount(aligned.of[0][aligned.begins[0]], minlength=n), np.bincount(of, minlength=n),
        ], axis=1)
        # A text and a pair in one number: texts of a batch are few.
        key = np.sort(of * np.int64(1 << 40) + pairs)
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(cuts, append=len(key))
        key = key[cuts]
        ends = np.searchsorted(key >> 40, np.arange(1, n))
        each = zip(np.split(key & ((1 << 40) - 1), ends), np.split(times, ends), strict=True)
        for k, (some, often) in enumerate(each):
            if groups[k]:
                found[first + k].add(counts[k], groups[k], some, often, keep)
    return found


def linked(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0], self.times[0]
        pairs, place = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]), return_inverse=True)
        times = np.bincount(place, np.concatenate([np.zeros(0), *self.times]), len(pairs))
        return pairs, times.astype(np.int64)


def _documents(aligner: _Aligner, texts: pa.Array, keep: bool = False) -> list[_Document]:
    found = [_Document.new() for _ in range(len(texts))]
    for first, aligned, groups, pairs in aligner.texts(texts):
        n = len(groups)
        of = aligned.of[0][aligned.links[0]]
        counts = np.stack([
            np.bincount(aligned.of[0], minlength=n), np.bincount(aligned.of[1], minlength=n),
            np.bincount(aligned.of[0][aligned.begins[0]], minlength=n), np.bincount(of, minlength=n),
        ], axis=1)
        # A text and a pair in one number: texts of a batch are few.
        key = np.sort(of * np.int64(1 << 40) + pairs)
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(cuts, append=len(key))
        key = key[cuts]
        ends = np.searchsorted(key >> 40, np.arange(1, n))
        each = zip(np.split(key & ((1 << 40) - 1), ends), np.split(times, ends), strict=True)
        for k, (some, often) in enumerate(each):
            if groups[k]:
                found[first + k].add(counts[k], groups[k], some, often, keep)
    return found


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about TEXT_AT_ONCE bytes, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    at, ends = 0, np.cumsum(sizes, dtype=np.int64)
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_AT_ONCE, "right")))
        yield batch.slice(at, end - at)
        at = end


def linked(docs: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """One row per document: counts of tokens, groups and links, the digest of the groups, and the
    distinct pairs of ids that are linked, as one number each, with how often they are; ``part``
    numbers runs of documents. Null, empty and inexactly coded texts have no tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, model))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        part, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for some in slices(batch, "text", TEXT_AT_ONCE):
                found = _documents(aligner, some.column(1))
                pairs, times = zip(*(d.linked() for d in found), strict=True) if found else ((), ())
                ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                n = np.array([d.n for d in found], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(found), pa.int64()),
                        some.column(0),
                        *[pa.array(n[:, k]) for k in range(4)],
                        pa.array([d.digest.hexdigest() if d.n[0] else "" for d in found], pa.string()),
                        pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int64), *pairs])),
                        pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *times]).astype(np.int32)),
                    ],
                    ["part", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )
                held += some.column(1).nbytes
                if held >= PART_BYTES:
                    part, held = part + 1, 0

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(link, _LINKED)


def _weigh(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of a part, with the counts of its pairs."""
    order = np.argsort(answers.column("pair").to_numpy())
    known, count = (answers.column(c).to_numpy()[order] for c in ("pair", "docs"))
    best = answers.column("best").to_numpy(zero_copy_only=False)[order]
    lists = docs.column("pairs").combine_chunks()
    pairs = pc.list_flatten(lists).to_numpy()
    times = pc.list_flatten(docs.column("times").combine_chunks()).to_numpy().astype(np.int64)
    of = np.repeat(np.arange(docs.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    place = np.searchsorted(known, pairs)
    if len(pairs) and (not len(known) or int(place.max()) >= len(known) or (known[place] != pairs).any()):
        raise RuntimeError("a part lacks the count of one of its pairs")
    weight = np.zeros(docs.num_rows, np.int64)
    n_best = np.zeros(docs.num_rows, np.int64)
    np.add.at(weight, of, times * count[place] if len(pairs) else times)
    np.add.at(n_best, of, times * best[place] if len(pairs) else times)
    return pa.table(
        [*[docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], pa.array(n_best), pa.array(weight),
         docs.column("groups_sha256")],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """(part, pair, here): documents of each part in which a pair is linked."""
    asked = rows.select("part", F.explode("pairs").alias("pair"))
    return asked.groupBy("part", "pair").agg(F.count(F.lit(1)).alias("here"))


def aligned(docs: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others aren't read): tokens of both sides, groups,
    links, and over the links the number that are the first choice of their first id in the corpus
    (ties are all first), and the sum of their counts of documents.

    Null and empty texts, and texts that a side doesn't spell byte by byte, have zeros and an empty
    digest. Rows that repeat count as often as they come; an empty table has no rows.
    """
    width = SentencePieceProcessor(model_proto=model).get_piece_size()
    rows = staged(linked(docs, tokenizer, model), "linked")
    asked = staged(pair_counts(rows), "asked-pairs")
    counts = asked.groupBy("pair").agg(F.sum("here").alias("docs")).withColumn("a", F.expr(f"pair div {width}"))
    counts = staged(counts, "pair-counts")
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    scored = counts.join(top, "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))
    answers = asked.select("part", "pair").join(scored, "pair").select("part", "pair", "docs", "best")
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_weigh, _RESULT)


def groups(docs: DataFrame, tokenizer: str, model: bytes) -> DataFrame:
    """``docs`` with ``groups``, the aligned ids of each text as `a1,a2|b1;a3|b2,b3`, empty where
    there are none; a column of that name is replaced."""
    kept = [c for c in docs.columns if c not in ("groups", "_text")]
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, model))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        for batch in batches:
            names = [*kept, "groups"]
            for some in slices(batch, "_text", TEXT_AT_ONCE):
                found = _documents(aligner, some.column("_text"), keep=True)
                text = pa.array(["".join(d.groups)[:-1] for d in found], pa.string())
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in kept], text], names)

    rows = docs.select(*kept, F.col("text").alias("_text"))
    return rows.mapInArrow(write, docs.select(*kept).schema.add("groups", "string"))


def piece_model(path: str | None = None) -> bytes:
    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the alignment of both vocabularies' tokens."""
    return aligned(documents(spark, sf_dir), tokenizer_file(), piece_model())
