"""Removing long strings that come twice, by sorting names of substrings at a difference cover.

A difference cover D modulo v holds, for any two places, a shift below v that moves both into the
sample of places that are in D modulo v. So two equal strings of length L have equal strings of
length L - v + 1 at sampled places, at the same shift. The operator

1. names the string of that length at each sampled place, and sorts the names of all parts; a name
   that is found once is discarded, and with it all that only it could match;
2. names the whole context, v - 1 bytes to the left and L to the right, where the first name was
   repeated; a context that comes twice settles every string in it;
3. merges the places that are left, sampled or not: names the L bytes from each, sorts them, and
   compares neighbours.

Names are 64-bit hashes; equal names count as equal strings. Sorting goes by buckets of names, so
it is spread over tasks, and every part of the table asks only with its distinct names.

The sort stops at L bytes, as nothing beyond can change the result: the full order of all suffixes
would move every byte's rank several times over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm import parts as P
from sitewind.llm.common import documents, tasks

LENGTH = 200
# Difference covers by their modulus, in which every difference occurs once.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 6, 15, 22, 26, 45, 55),
    133: (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121),
}
#: Bytes sent of a first name, which only has to tell most apart, and of the others.
FILTER_WIDTH, WIDTH = 5, 7
#: Bytes of text that a bucket stands for.
BUCKET_BYTES = 4 << 20
_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def modulus(length: int) -> int:
    """The largest that leaves the sampled names a third of the length."""
    return max(v for v in COVERS if v == 7 or length - v + 1 >= length / 3)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    letters = draw.integers(0, _ALL, 256, dtype=np.uint64, endpoint=True) | np.uint64(1)

    def powers(base: int) -> np.ndarray:
        factors = np.full(2 * _BLOCK, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return letters, powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class Hashes:
    """Hashes of substrings of a buffer, from running sums over blocks that overlap."""

    def __init__(self, data: np.ndarray, reach: int) -> None:
        letters, powers, self.inverse = _powers()
        self.size, sums = len(data), []
        for at in range(0, max(len(data), 1), _BLOCK):
            part = letters[data[at : at + _BLOCK + reach]] * powers[: len(data[at : at + _BLOCK + reach])]
            sums.append(np.concatenate([[np.uint64(0)], np.cumsum(part, dtype=np.uint64)]))
        self.sums = sums

    def at(self, begins: np.ndarray, lengths) -> np.ndarray:
        """Hashes of the strings of these lengths from these places, which ascend."""
        found = np.empty(len(begins), np.uint64)
        lengths = np.broadcast_to(lengths, begins.shape)
        cuts = np.searchsorted(begins, np.arange(len(self.sums) + 1) * _BLOCK)
        for block, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            local = begins[a:b] - block * _BLOCK
            sums = self.sums[block]
            found[a:b] = (sums[local + lengths[a:b]] - sums[local]) * self.inverse[local]
        return _mixed(found)


class _Part:
    """Texts of a part as one buffer, with the places and names that the steps need."""

    def __init__(self, table: pa.Table, length: int) -> None:
        texts = table.column("text").to_pylist()
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.length, self.v = length, modulus(length)
        self.hashes = Hashes(self.data, length + self.v)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places from which a first name lies inside a text, and these names."""
        cover = np.zeros(self.v, bool)
        cover[list(COVERS[self.v])] = True
        short = self.length - self.v + 1
        places = []
        for begin, end in zip(self.begins.tolist(), self.ends.tolist(), strict=True):
            # Texts that are too short for a string of the length have nothing to match.
            if end - begin >= self.length:
                inside = np.flatnonzero(cover[np.arange(end - begin - short + 1) % self.v])
                places.append(inside + begin)
        found = np.concatenate(places) if places else np.zeros(0, np.int64)
        return found, self.hashes.at(found, short)

    def _bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of = np.searchsorted(self.ends, places, "right")
        return self.begins[of], self.ends[of]

    def contexts(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of the context of each sampled place, cut at the ends of its text, and its
        name, which tells where in it the place is."""
        low, high = self._bounds(places)
        begin = np.maximum(places - (self.v - 1), low)
        end = np.minimum(places + self.length, high)
        order = np.argsort(begin, kind="stable")
        name = np.empty(len(places), np.uint64)
        name[order] = self.hashes.at(begin[order], (end - begin)[order])
        left = (places - begin).astype(np.uint64)
        return begin, end, _mixed(name + (left * np.uint64(512) + (end - begin).astype(np.uint64)) * np.uint64(_BASE))

    def spread(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which places lie in any of these ranges."""
        marks = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(marks, begin, 1)
        np.add.at(marks, end, -1)
        return np.cumsum(marks[:-1], dtype=np.int32) > 0

    def starts(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places from which a string of the length lies inside one of these contexts."""
        long = end - begin >= self.length
        return self.spread(begin[long], end[long] - self.length + 1)


def _known(names: np.ndarray, answers: list[tuple[int, bytes]], buckets: int, width: int) -> np.ndarray:
    """Which names are among the answered ones."""
    bucket, rest = P.split_key(names, buckets, width)
    found = np.zeros(len(names), bool)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], [[b, b + 1] for b, _ in answers]).reshape(-1, 2)
    for (_, packed), (a, b) in zip(answers, cuts, strict=True):
        keys = P._wide(packed, width)
        mine = order[a:b]
        if len(keys) and len(mine):
            place = np.minimum(np.searchsorted(keys, rest[mine]), len(keys) - 1)
            found[mine] |= keys[place] == rest[mine]
    return found


# Kinds of names in packets: those that want an answer, and those that are there to be compared with.
ASKED, SHOWN = 0, 1
# Kinds of answers: names that come twice, and those of them that the part shows for all others.
TWICE, CHOSEN = 0, 1


def _asked(
    part: int, names: np.ndarray, asking: np.ndarray, buckets: int, width: int
) -> Iterator[pa.RecordBatch]:
    distinct, place, counts = np.unique(names, return_inverse=True, return_counts=True)
    wanted = np.zeros(len(distinct), bool)
    wanted[place[asking]] = True
    twice = (counts > 1).astype(np.uint8)
    for kind, some in ((ASKED, wanted), (SHOWN, ~wanted)):
        if some.any():
            yield P.packets(part, kind, distinct[some], buckets, width, twice[some])


def _repeated(width: int):
    """Sort a bucket's names, compare neighbours, and tell each part which of its own come twice. Of
    the parts that have a name the first is chosen to show it from then on."""

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("kind", "ascending")])
        keys, cuts = P.unpacked(table.column("keys").to_pylist(), width)
        twice = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8) > 0
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        same = ordered[1:] == ordered[:-1]
        later = np.zeros(len(keys), bool)
        later[order[1:][same]] = True
        repeated = later | twice
        repeated[order[:-1][same]] = True
        chosen = repeated & ~later
        rows = []
        packets = zip(
            *(table.column(c).to_pylist() for c in ("bucket", "part", "kind")),
            *(np.split(x, cuts) for x in (keys, repeated, chosen)),
            strict=True,
        )
        for bucket, part, kind, names, is_twice, is_chosen in packets:
            if kind == ASKED:
                rows += [(bucket, part, of, P._narrow(np.sort(names[x]), width)) for of, x in ((TWICE, is_twice), (CHOSEN, is_chosen))]
        return pa.table(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            ["bucket", "part", "kind", "answer"],
        )

    return answer


def repeated_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; others aren't read): doc_id, n_bytes, spans
    (ARRAY<STRUCT<start, end>>: the maximal runs of bytes that lie in a string of ``length`` bytes
    which also starts elsewhere, here or in another text) and kept (BINARY, the other bytes).

    Texts are bytes in UTF-8, a null text is empty; strings lie within one text. Of equal rows all
    are found, as each has the other. Runs are judged on the input, so no copy of one stays.
    """
    held = P.in_parts(docs)
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(256, tasks(docs.sparkSession), total // BUCKET_BYTES)

    def ask(step, width: int, name: str) -> P.Answers:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, table in P.by_part(batches):
                yield from _asked(part, *step(part, _Part(table, length)), buckets, width)

        asked = held.select("part", "text").mapInArrow(each, P.PACKET)
        return P.Answers(asked.groupBy("bucket").applyInArrow(_repeated(width), P.ANSWER), name)

    def first(part: int, texts: _Part) -> tuple[np.ndarray, np.ndarray]:
        names = texts.samples()[1]
        return names, np.ones(len(names), bool)

    read_first = ask(first, FILTER_WIDTH, "first-names").reader()

    def contexts(part: int, texts: _Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places, names = texts.samples()
        return texts.contexts(places[_known(names, read_first(part, TWICE), buckets, FILTER_WIDTH)])

    def second(part: int, texts: _Part) -> tuple[np.ndarray, np.ndarray]:
        names = contexts(part, texts)[2]
        return names, np.ones(len(names), bool)

    read_second = ask(second, WIDTH, "contexts").reader()

    def settled(part: int, texts: _Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose string is known to come twice; those that this part shows for them; those
        that are open."""
        begin, end, names = contexts(part, texts)
        sure, shown = (
            texts.starts(begin[is_in], end[is_in])
            for is_in in (_known(names, read_second(part, kind), buckets, WIDTH) for kind in (TWICE, CHOSEN))
        )
        return sure, shown, texts.starts(begin, end) & ~sure

    def third(part: int, texts: _Part) -> tuple[np.ndarray, np.ndarray]:
        # An open string may come twice with a settled one, which one part shows for all that have it.
        _, shown, is_open = settled(part, texts)
        places = np.flatnonzero(shown | is_open)
        return texts.hashes.at(places, length), is_open[places]

    read_third = ask(third, WIDTH, "strings").reader()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in P.by_part(batches):
            texts = _Part(table, length)
            sure, _, is_open = settled(part, texts)
            places = np.flatnonzero(is_open)
            names = texts.hashes.at(places, length)
            sure[places[_known(names, read_third(part, TWICE), buckets, WIDTH)]] = True
            starts = np.flatnonzero(sure)
            gone = texts.spread(starts, starts + length)
            spans, kept = [], []
            for begin, end in zip(texts.begins.tolist(), texts.ends.tolist(), strict=True):
                mine = gone[begin:end]
                edges = np.flatnonzero(np.diff(mine, prepend=False, append=False))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                kept.append(texts.data[begin:end][~mine].tobytes())
            yield from pa.table(
                {
                    "doc_id": table.column("doc_id"),
                    "n_bytes": table.column("n_bytes"),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    "kept": pa.array(kept, pa.binary()),
                }
            ).combine_chunks().to_batches()

    return held.mapInArrow(
        remove, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with what is removed of them, and a digest of the rest."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return repeated_strings(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
