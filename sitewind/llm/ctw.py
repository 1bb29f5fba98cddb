"""Scoring texts by context-tree weighting over bytes.

A byte is eight binary decisions, a path through a tree of 255 nodes. Each node has a context tree
of its own: the bytes before are the contexts, up to ``DEPTH`` of them. A context's estimate is that
of Krichevsky and Trofimov from its counts; its weighted probability is half its own estimate's and
half the product of those of the contexts one byte longer. So a prediction mixes the estimates of all
depths, each with the weight that the training texts give it. A context never seen in training leaves
the mix at the deepest one that was.

Counts are learned first and then stand still, so a byte's probability follows from it and the bytes
before: each part of the table asks for its distinct strings of ``DEPTH + 1`` bytes. Their counts
are summed by buckets, the trees are built by the last two bytes of the contexts, and the answers go
back to the parts. The trees grow with the texts; no task holds more than those of two last bytes.

The part above two bytes has at most 256 * 255 nodes and is the only one that every task gets.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm import parts as P
from sitewind.llm.common import documents, staged, tasks
from sitewind.llm.substrings import Hashes, _mixed

DEPTH = 4
#: Of ten remainders of the id's checksum, the one that isn't learned from.
HELD_OUT = 0
#: Bytes of text that a bucket stands for.
BUCKET_BYTES = 4 << 20
WORDS, GRAMS = 0, 1
_GRAM_WIDTH, _WORD_WIDTH = 5, 7
_END = np.uint64(1)
_LONG = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


_ODD = 0x9E3779B97F
_KEYS = np.uint64((1 << 40) - 1)


def _scattered(keys: np.ndarray, factor: int) -> np.ndarray:
    keys = keys ^ keys >> np.uint64(20)
    keys = keys * np.uint64(factor) & _KEYS
    return keys ^ keys >> np.uint64(20)


def key_of(grams: np.ndarray) -> np.ndarray:
    """A string of five bytes as a number that tells nothing of its last byte, so that buckets of it
    are even."""
    return _scattered(grams, _ODD)


def gram_of(keys: np.ndarray) -> np.ndarray:
    return _scattered(keys, pow(_ODD, -1, 1 << 40))


def held_out(doc_id: int | None) -> bool:
    """Whether a document isn't learned from; one without an id isn't."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == HELD_OUT


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers: Stirling's series after eight steps up."""
    steps = np.ones_like(x)
    for k in range(8):
        steps = steps * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(steps)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the estimate of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - 2 * math.lgamma(0.5) - log_gamma(zeros + ones + 1.0)


class _Level:
    """One of the eight decisions, for strings whose contexts end in the same two bytes: counts and
    weighted probabilities of their nodes at depths DEPTH to 2."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, level: int) -> None:
        byte = (grams & np.uint64(255)).astype(np.int64)
        self.node = (1 << level) | byte >> (8 - level)
        self.bit = byte >> (7 - level) & 1
        self.place, self.zeros, self.ones, self.log, self.own = {}, {}, {}, {}, {}
        below = None
        for depth in range(DEPTH, 1, -1):
            context = grams >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)
            keys, place = np.unique(context << np.uint64(8) | self.node.astype(np.uint64), return_inverse=True)
            ones = np.bincount(place, counts * self.bit, len(keys))
            zeros = np.bincount(place, counts, len(keys)) - ones
            own = log_estimate(zeros, ones)
            if below is None:
                log = own
            else:
                # Children one byte longer, each counted once.
                first = np.zeros(len(self.log[depth + 1]), np.int64)
                first[below] = place
                log = np.logaddexp(own, np.bincount(first, self.log[depth + 1], len(keys))) - math.log(2)
            self.place[depth], self.zeros[depth], self.ones[depth] = place, zeros, ones
            self.own[depth], self.log[depth] = own, log
            self.keys = keys
            below = place

    def mixed(self) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one at depth 2, for each string, and whether it was seen there."""
        found = np.full(len(self.bit), 0.5)
        seen = np.zeros(len(self.bit), bool)
        for depth in range(DEPTH, 1, -1):
            at = self.place[depth]
            n = self.zeros[depth] + self.ones[depth]
            own = ((self.ones[depth] + 0.5) / (n + 1))[at]
            if depth == DEPTH:
                weight = np.ones(len(at))
            else:
                weight = np.exp(np.minimum(self.own[depth] - math.log(2) - self.log[depth], 0))[at]
            found = np.where(seen, weight * own + (1 - weight) * found, own)
            seen = (n > 0)[at]
        return found, seen


def _strings(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy().astype(np.float64)


def _summary(table: pa.Table) -> pa.Table:
    grams, counts = _strings(table)
    rows = []
    for level in range(8):
        at = _Level(grams, counts, level)
        last = (at.keys >> np.uint64(8) & np.uint64(255)).astype(np.int64)
        rows.append((last, (at.keys & np.uint64(255)).astype(np.int64), at.zeros[2], at.ones[2], at.log[2]))
    return pa.table(
        [np.concatenate([r[i] for r in rows]) for i in range(5)], ["last", "node", "zeros", "ones", "log"]
    )


class Top:
    """The contexts of one and no byte: what they add to a prediction."""

    def __init__(self, rows: list) -> None:
        zeros, ones, log = (np.zeros((256, 256)) for _ in range(3))
        for last, node, n0, n1, below in rows:
            zeros[last, node], ones[last, node], log[last, node] = n0, n1, below
        own = log_estimate(zeros, ones)
        total = np.logaddexp(own, log) - math.log(2)
        self.weight = np.exp(np.minimum(own - math.log(2) - total, 0))
        self.own, self.seen = (ones + 0.5) / (zeros + ones + 1), zeros + ones > 0
        zeros, ones, log = zeros.sum(0), ones.sum(0), total.sum(0)
        own = log_estimate(zeros, ones)
        self.root_weight = np.exp(np.minimum(own - math.log(2) - (np.logaddexp(own, log) - math.log(2)), 0))
        self.root = (ones + 0.5) / (zeros + ones + 1)

    def mixed(self, last: np.ndarray, node: np.ndarray, below: np.ndarray, seen: np.ndarray) -> np.ndarray:
        own, weight = self.own[last, node], self.weight[last, node]
        found = np.where(seen, weight * own + (1 - weight) * below, own)
        own, weight = self.root[node], self.root_weight[node]
        return np.where(self.seen[last, node], weight * own + (1 - weight) * found, own)


def log10_probabilities(grams: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """Of the last byte of each string after the others."""
    last = (grams >> np.uint64(8) & np.uint64(255)).astype(np.int64)
    found = np.zeros(len(grams))
    for level in range(8):
        at = _Level(grams, counts, level)
        one = top.mixed(last, at.node, *at.mixed())
        found += np.log10(np.where(at.bit == 1, one, 1 - one))
    return found


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in no order, and the place of each key's own."""
    found = pa.array(keys).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


class _Texts:
    """Texts of a part, lower-cased, with zero bytes before, between and after them: the first of
    these after a text is its end, and is scored like a byte."""

    def __init__(self, table: pa.Table) -> None:
        texts = [t for t in table.column("text").to_pylist()]
        gap = bytes(DEPTH)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.data = _LOWER[np.frombuffer(gap + gap.join(texts) + gap, np.uint8)]
        self.begins = DEPTH + np.cumsum(self.sizes + DEPTH) - (self.sizes + DEPTH)
        self.doc_ids = table.column("doc_id").to_pylist()
        self.learned = ~np.array([held_out(i) for i in self.doc_ids], bool)
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.begins] += 1
        np.subtract.at(inside, self.begins + self.sizes, 1)
        self.inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the distinct strings that end in a scored byte, the place of each scored byte's
        among them, and the text each is of."""
        scored = self.inside.copy()
        scored[self.begins + self.sizes] = True
        n = len(self.data) - DEPTH
        found = self.data[:n].astype(np.uint64)
        for at in range(1, DEPTH + 1):
            found <<= np.uint64(8)
            found |= self.data[at : at + n]
        distinct, place = _distinct(found[scored[DEPTH:]])
        return key_of(distinct), place, np.repeat(np.arange(len(self.sizes)), self.sizes + 1)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the distinct tokens, the place of each token's among them, ends last, and the text
        each is of."""
        word = self.inside & ~_SPACE[self.data]
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        begins, ends = edges[::2], edges[1::2]
        lengths = ends - begins
        short = np.minimum(lengths, _LONG)
        found = _mixed(Hashes(self.data, _LONG).at(begins, short) + lengths.astype(np.uint64))
        for at in np.flatnonzero(lengths > _LONG).tolist():
            whole = self.data[begins[at] : ends[at]].tobytes()
            found[at] = zlib.crc32(whole) << 32 | zlib.adler32(whole)
        of = np.searchsorted(self.begins, begins, "right") - 1
        n = len(self.sizes)
        return *_distinct(np.concatenate([found, np.full(n, _END)])), np.concatenate([of, np.arange(n)])

    def learned_counts(self, distinct: np.ndarray, place: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distinct, np.bincount(place[self.learned[of]], minlength=len(distinct)).astype("<u4")


def scored(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others aren't read): doc_id, held_out, n_bytes,
    n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Texts are UTF-8 with A-Z as a-z. ``score`` is the log10 probability of a text's bytes and its end;
    ``base_score`` that of its words and its end by their counts. A null text is empty and has its end
    alone. A text comes as often as its row; without texts to learn from all bits are even.
    """
    spark = docs.sparkSession
    held = P.in_parts(docs)
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(256, tasks(spark), total // BUCKET_BYTES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in P.by_part(batches):
            texts = _Texts(table)
            for kind, keys, width in ((WORDS, texts.words(), _WORD_WIDTH), (GRAMS, texts.grams(), _GRAM_WIDTH)):
                distinct, counts = texts.learned_counts(*keys)
                yield P.packets(part, kind, distinct, buckets, width, counts)

    asked = staged(held.select("part", "doc_id", "text").mapInArrow(ask, P.PACKET), "asked")

    # Words: totals go back to the parts, and their number and sum to the driver.
    count = P.counted(_WORD_WIDTH, "<u8", lambda totals: struct.pack("<qq", int((totals > 0).sum()), int(totals.sum())))
    word_answers = P.Answers(
        asked.where(f"kind = {WORDS}").groupBy("bucket").applyInArrow(count, P.ANSWER), "words"
    )
    sums = [struct.unpack("<qq", a) for _, a in word_answers.reader()(-1, WORDS)]
    vocabulary, train_tokens = (sum(s[i] for s in sums) for i in range(2))

    # Strings: their totals, the trees, and the probabilities.
    def totals(table: pa.Table) -> pa.Table:
        keys, _ = P.unpacked(table.column("keys").to_pylist(), _GRAM_WIDTH)
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
        bucket = table.column("bucket")[0].as_py()
        whole = gram_of(distinct * np.uint64(buckets) + np.uint64(bucket))
        return pa.table(
            [np.full(len(distinct), bucket), whole.astype(np.int64), np.bincount(place, counts, len(distinct)).astype(np.int64)],
            ["bucket", "gram", "n"],
        )

    grams = asked.where(f"kind = {GRAMS}")
    found = staged(grams.groupBy("bucket").applyInArrow(totals, "bucket bigint, gram bigint, n bigint"), "strings")
    by_ending = found.groupBy(F.expr("shiftright(gram, 8) & 65535").alias("ending"))
    summary = by_ending.applyInArrow(_summary, "last bigint, node bigint, zeros double, ones double, log double")
    top = Top(
        summary.groupBy("last", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log")]).collect()
    )

    def predict(table: pa.Table) -> pa.Table:
        logs = log10_probabilities(*_strings(table), top)
        return pa.table([table.column("bucket"), table.column("gram"), logs], ["bucket", "gram", "log10"])

    model = by_ending.applyInArrow(predict, "bucket bigint, gram bigint, log10 double")

    def answer(packets: pa.Table, model: pa.Table) -> pa.Table:
        names = key_of(model.column("gram").to_numpy().astype(np.uint64))
        order = np.argsort(names)
        names, logs = names[order], model.column("log10").to_numpy()[order]
        rows = [[], [], [], []]
        for bucket, part, kind, packed in zip(*(packets.column(c).to_pylist() for c in ("bucket", "part", "kind", "keys")), strict=True):
            keys = P._wide(packed, _GRAM_WIDTH)
            place = np.searchsorted(names, keys * np.uint64(buckets) + np.uint64(bucket))
            for column, value in zip(rows, (bucket, part, kind, P.keyed(keys, logs[place], _GRAM_WIDTH, "<f4")), strict=True):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array(r, t) for r, t in zip(rows, types, strict=True)], ["bucket", "part", "kind", "answer"])

    gram_answers = P.Answers(
        grams.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(answer, P.ANSWER), "predictions"
    )

    read_words, read_grams = word_answers.reader(), gram_answers.reader()
    every = math.log10(train_tokens + 0.1 * (vocabulary + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in P.by_part(batches):
            texts = _Texts(table)
            n = len(texts.sizes)

            def summed(
                distinct: np.ndarray, place: np.ndarray, of: np.ndarray, answers: list, width: int, values: str, *each
            ) -> list[np.ndarray]:
                known = P.look_up(distinct, answers, buckets, width, values).astype(np.float64)
                return [np.bincount(of, f(known)[place], n) for f in each]

            words = texts.words()
            n_tokens = np.bincount(words[-1], minlength=n)
            base, n_known = summed(*words, read_words(part, WORDS), _WORD_WIDTH, "<u8", lambda c: np.log10(c + 0.1), lambda c: c > 0)
            (logs,) = summed(*texts.grams(), read_grams(part, GRAMS), _GRAM_WIDTH, "<f4", lambda x: x)
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("doc_id").combine_chunks(),
                    pa.array(~texts.learned),
                    pa.array(texts.sizes),
                    pa.array(n_tokens.astype(np.int64)),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(np.full(n, train_tokens, np.int64)),
                    pa.array(base - n_tokens * every),
                    pa.array(logs),
                    pa.array(-logs * math.log2(10) / np.maximum(texts.sizes, 1)),
                ],
                ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
            )

    return held.select("part", "doc_id", "text").mapInArrow(
        score,
        "doc_id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, bits_per_byte double",
    )


def op3_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the log10 probabilities of their texts by both models."""
    return scored(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
