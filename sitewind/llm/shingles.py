"""Documents whose sets of word n-grams overlap, found by a token-group matrix.

A token is the name of an n-gram; a document's set is sorted by names. Sets that are equal are one set. Sets of
similar documents form groups of bounded size, and the matrix has the union of each group's tokens. A
set asks the matrix for its rarest tokens, as many as must hold one of any partner's; a group it
meets is opened if the group's tokens could cover enough of it, and then it is compared with each member.

Only components are wanted, so groups are linked within first and then by their middles; a set doesn't
ask groups that are wholly of its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.llm.common import documents, shuffles_released, staged, tasks
from sitewind.llm.components import components
from sitewind.llm.parts import ANSWER, PACKET, by_part, keyed, look_up, packets, unpacked

LENGTH = 3
PERCENT = 90
#: Bytes of text at once, and of a part; tokens of a group, and of the sets that ask it at once, about.
PART_BYTES = 8 << 20
GROUP_TOKENS = 1 << 16
#: Tokens of prefixes that share a bucket, and bytes of a name that a bucket needs: names are 64 bits,
#: of which the bucket's number holds 8.
BUCKET_TOKENS = 1 << 19
_WIDTH = 7
#: Sizes of sets in one class differ by this factor at most, which is that of partners at PERCENT.
SIZE_STEP = 1.1

# Odd numbers, one per place of an n-gram: multiples of the golden ratio's fraction.
_GOLDEN = 0x9E3779B97F4A7C15


def least_overlap(n, percent: int = PERCENT):
    """Tokens that a set of ``n`` shares with any set it is linked with, and so the least size of that."""
    return -(-n * percent // 100)


def missing(n, percent: int = PERCENT):
    """Tokens of a set of ``n`` that a partner may lack."""
    return n - least_overlap(n, percent)


def kept_length(n, percent: int = PERCENT):
    """Of a set's tokens by name, how many the matrix has: so many more than may be missing that the
    first ``missing(n) + k`` of two partners have ``k`` in common, for each ``k`` to ``missing(n) + 1``."""
    return 2 * missing(n, percent) + 1


def asked_length(n, percent: int = PERCENT):
    """Of a set's tokens by name, how many may ask: all but ``missing(n)`` of them are among the tokens
    that the matrix has of any partner that isn't larger."""
    return missing(n, percent) + missing(least_overlap(n, percent), percent) + 1


def names(texts: pa.Array, length: int = LENGTH) -> list[np.ndarray]:
    """The distinct n-grams of each text by name, sorted; A-Z count as a-z. Fewer words make one."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    words = pc.list_flatten(lists).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False)
    # Distinct words are few: their letters are lowered here, and not those of the texts.
    spelled = [w.lower() for w in words.dictionary.cast(pa.binary()).to_pylist()]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, spelled), np.uint64, len(spelled))[codes]
    real = np.fromiter(map(bool, spelled), bool, len(spelled))[codes]
    ends = np.asarray(lists.offsets, np.int64)
    ends = np.concatenate([[0], np.cumsum(real)])[ends[1:] - ends[0]]
    codes, hashes = codes[real], hashes[real]
    if len(hashes) >= length:
        grams = np.zeros(len(hashes) - length + 1, np.uint64)
        for k in range(length):
            odd = np.uint64((_GOLDEN * (2 * k + 1)) % (1 << 64))
            grams += hashes[k : len(hashes) - length + 1 + k] * odd
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(_GOLDEN)
        grams ^= grams >> np.uint64(29)
    found, start = [], 0
    for end in ends.tolist():
        if end - start >= length:
            found.append(np.unique(grams[start : end - length + 1]))
        else:
            whole = b" ".join(spelled[c] for c in codes[start:end])
            found.append(np.array([xxhash.xxh64_intdigest(whole)] if whole else [], np.uint64))
        start = end
    return found


def _slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(from, to, bytes) of rows of about PART_BYTES bytes, or of one longer row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield at, end, int(ends[end - 1]) - before
        at = end


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int64), *(a.view(np.int64) for a in arrays)]))


def prefixes(docs: DataFrame, length: int = LENGTH, percent: int = PERCENT) -> DataFrame:
    """(part, row, doc_id, n, digest, tokens): the size and the digest of each document's set, and its
    first tokens by name. ``row`` tells rows apart, ``part`` runs of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = row = TaskContext.get().partitionId() << 32
        held = 0
        for batch in batches:
            for at, end, size in _slices(batch, batch.column(1)):
                if held and held + size > PART_BYTES:
                    part, held = part + 1, 0
                held += size
                sets = names(batch.column(1).slice(at, end - at), length)
                n = np.array([len(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(sets), pa.int64()),
                        pa.array(np.arange(row, row + len(sets))),
                        batch.column(0).slice(at, end - at),
                        pa.array(n),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        _lists([s[: kept_length(len(s), percent)] for s in sets]),
                    ],
                    ["part", "row", "doc_id", "n", "digest", "tokens"],
                )
                row += len(sets)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(
        read, "part bigint, row bigint, doc_id bigint, n bigint, digest binary, tokens array<bigint>"
    )


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = table.column("tokens").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return pc.list_flatten(lists).to_numpy().view(np.uint64), sizes.astype(np.int64)


def _asking(buckets: int):
    """For ``mapInArrow``: a part's distinct tokens, with their counts, by bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in by_part(batches):
            keys, counts = np.unique(_tokens(table)[0], return_counts=True)
            if len(keys):
                yield packets(part, 0, keys, buckets, _WIDTH, counts.astype("<u4"))

    return ask


def _shared(table: pa.Table) -> pa.Table:
    """For ``applyInArrow``: of the tokens in a bucket, those of two rows or more go back to each part
    that has them, with their counts."""
    keys, cuts = unpacked(table.column("keys").to_pylist(), _WIDTH)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
    distinct, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, counts, len(distinct)).astype(np.int64)[place]
    bucket = table.column("bucket")[0].as_py()
    rows = [
        (bucket, part, 0, keyed(k[t > 1], t[t > 1], _WIDTH, "<i8"))
        for part, k, t in zip(table.column("part").to_pylist(), np.split(keys, cuts), np.split(totals, cuts), strict=True)
        if (t > 1).any()
    ]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.table(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["bucket", "part", "kind", "answer"]
    )


_LIVE = "row bigint, doc_id bigint, n bigint, digest binary, asks array<bigint>, shared array<bigint>, middle double"


def _live(buckets: int, percent: int):
    """For a cogrouped part and its answers: rows that may have a partner. ``asks`` are the rarest
    tokens that must hold one of each partner's, ``shared`` those that others have at all, and
    ``middle`` is larger the more of its tokens others have."""

    def find(rows: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, sizes = _tokens(rows)
        # Several runs of a part may have asked; the first answer for a token is as good as the next.
        given = sorted(zip(answers.column("bucket").to_pylist(), answers.column("answer").to_pylist(), strict=True))
        counts = look_up(tokens, given, buckets, _WIDTH, "<i8")
        ends = np.cumsum(sizes)
        kept, asks, shared, middle = [], [], [], []
        for at, (n, start, end) in enumerate(zip(rows.column("n").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True)):
            if not n:
                continue
            mine, often = tokens[start:end], counts[start:end]
            may = asked_length(n, percent)
            lack = int((often[:may] == 0).sum())
            if lack > missing(n, percent):
                continue
            order = np.argsort(often[:may], kind="stable")[lack : missing(n, percent) + 1]
            kept.append(at)
            asks.append(mine[:may][order])
            shared.append(mine[often > 0])
            middle.append(float(often.mean()))
        some = rows.take(pa.array(kept, pa.int64()))
        return pa.table(
            [*[some.column(c) for c in ("row", "doc_id", "n", "digest")], _lists(asks), _lists(shared), pa.array(middle, pa.float64())],
            ["row", "doc_id", "n", "digest", "asks", "shared", "middle"],
        )

    return find


def live(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of staged ``prefixes``, the rows that may have a partner."""
    total = rows.agg(F.sum(F.size("tokens").cast("bigint"))).first()[0] or 0
    buckets = max(256, -(-total // BUCKET_TOKENS))
    answers = (
        rows.select("part", "tokens").mapInArrow(_asking(buckets), PACKET)
        .groupBy("bucket").applyInArrow(_shared, ANSWER).select("part", "bucket", "answer").toDF("part", "bucket", "answer")
    )
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _live(buckets, percent), _LIVE
    )


def _sets(docs: DataFrame, length: int) -> DataFrame:
    """(digest, tokens) of documents: whole sets, packed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, _ in _slices(batch, batch.column(0)):
                sets = [s.tobytes() for s in names(batch.column(0).slice(at, end - at), length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                    ["digest", "tokens"],
                )

    return docs.select("text").mapInArrow(read, "digest binary, tokens binary")


def size_class(n: Column) -> Column:
    """A number that sets of about ``n`` tokens have in common."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / math.log(SIZE_STEP)).cast("int")


def grouped(members: DataFrame, key: Column, kind: Column | None = None) -> DataFrame:
    """``members`` (with n) with ``group``: rows of one key come together, in as many groups as their
    tokens fill; keys with few tokens share groups, those of one ``kind`` (an int) if there is one."""
    keyed_rows = members.withColumns({"key": key, "kind": F.lit(0) if kind is None else kind})
    sums = keyed_rows.groupBy("key", "kind").agg(F.sum("n").alias("tokens"))
    # One number per kind, and few kinds; a group of several keys is chosen among so many.
    totals = keyed_rows.groupBy("kind").agg(F.sum("n")).collect()
    numbers = [F.lit(x) for kind, total in totals for x in (kind, max(1, -(-total // GROUP_TOKENS)))]
    few = F.coalesce(F.create_map(*numbers)[F.col("kind")], F.lit(1)) if numbers else F.lit(1)
    large = sums.where(F.col("tokens") > GROUP_TOKENS).select(
        "key", "kind", F.ceil(F.col("tokens") / GROUP_TOKENS).cast("int").alias("split")
    )
    own = F.xxhash64("key", "kind", F.pmod(F.xxhash64("row"), F.col("split")))
    together = F.xxhash64("kind", F.pmod(F.xxhash64("key"), few))
    return (
        keyed_rows.join(large, ["key", "kind"], "left")
        .withColumn("group", F.when(F.col("split").isNull(), together).otherwise(own))
        .drop("key", "kind", "split")
    )


class _Group:
    """The members of a group: their tokens sorted, with whose they are."""

    def __init__(self, table: pa.Table, percent: int) -> None:
        self.percent = percent
        self.row, self.n, self.component = (table.column(c).to_numpy() for c in ("row", "n", "component"))
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64)
        owner = np.repeat(np.arange(len(self.row)), self.n)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        at = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] + np.uint64(1))) if len(tokens) else np.zeros(0, np.int64)
        self.union, self.begin = tokens[at], np.append(at, len(tokens))

    def partners(self, tokens: np.ndarray, component: int) -> np.ndarray:
        """Places of the members of other components that a set is linked with."""
        n = len(tokens)
        if not len(self.union):
            return np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        place = place[self.union[place] == tokens]
        # The bound: what the group's tokens leave uncovered, each of its members does.
        if len(place) < least_overlap(n, self.percent):
            return np.zeros(0, np.int64)
        start, sizes = self.begin[place], self.begin[place + 1] - self.begin[place]
        ends = np.cumsum(sizes)
        owners = self.owner[np.arange(ends[-1]) + np.repeat(start - (ends - sizes), sizes)]
        both = np.bincount(owners, minlength=len(self.n))
        near = 100 * both >= self.percent * (self.n + n - both)
        return np.flatnonzero(near & (self.component != component))

    def links(self, asking: pa.Table) -> pa.Table:
        """One link to each component that an asking set is linked with here."""
        found: list[tuple[int, int]] = []
        rows, components_of = (asking.column(c).to_numpy() for c in ("row", "component"))
        for row, component, packed in zip(rows.tolist(), components_of.tolist(), asking.column("tokens"), strict=True):
            partners = self.partners(np.frombuffer(packed.as_buffer(), np.uint64), component)
            _, first = np.unique(self.component[partners], return_index=True)
            found += [(row, other) for other in self.row[partners[first]].tolist() if other != row]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


_LINKS = "a bigint, b bigint"


def _within(percent: int):
    def link(table: pa.Table) -> pa.Table:
        return _joined(_Group(table, percent).links(table))

    return link


def _joined(links: pa.Table) -> pa.Table:
    """Links that join the same rows, one per row at most."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True):
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    rows = [(x, root(x)) for x in list(parent) if root(x) != x]
    return pa.table({"a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64())})


def _between(percent: int):
    def link(asking: pa.Table, members: pa.Table) -> pa.Table:
        if not asking.num_rows or not members.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return _Group(members, percent).links(asking)

    return link


def _linked_within(members: DataFrame, key: Column, percent: int) -> DataFrame:
    """Links among the members of each group; every member counts as a component of its own."""
    some = grouped(members.withColumn("component", F.col("row")), key)
    return some.select("group", "row", "n", "component", "tokens").groupBy("group").applyInArrow(_within(percent), _LINKS)


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    found = staged(components(links), "components").withColumnRenamed("node", "row")
    return members.join(found, "row", "left").withColumn("component", F.coalesce("component", "row"))


def links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): rows of ``members`` (row, n, asks, shared, middle, tokens: staged, of distinct sets) such
    that linked rows, and no others, are joined by such pairs."""
    first_token = F.get("shared", F.lit(0))
    within = staged(_linked_within(members, first_token, percent), "links-within")

    # The middles of what has been linked: large families are few components from here on.
    labelled = _labelled(members.select("row", "n", "middle", first_token.alias("first")), within)
    middles = labelled.groupBy("component").agg(
        F.max(F.struct("middle", "row", "first")).alias("best"), F.count(F.lit(1)).alias("size")
    ).where("size > 1").select(F.col("best.row").alias("row"))
    middle_links = staged(
        _linked_within(members.join(middles, "row", "left_semi"), first_token, percent), "links-of-middles"
    )
    known = within.union(middle_links)

    labels = _labelled(members.select("row", "n", first_token.alias("first")), known)
    # A set can only be linked with sets of about its size, so no others share its group: else short
    # sets would ask most groups, and as many times as there are more groups be sent to them.
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.avg("n").alias("about"))
    key = F.when(F.col("size") > 1, F.col("component")).otherwise(F.col("first"))
    labels = staged(
        grouped(labels.join(sizes, "component"), key, size_class(F.col("about"))).select(
            "row", "n", "component", "group"
        ),
        "groups",
    )
    whole = labels.groupBy("group").agg(
        F.min("n").alias("least"), F.max("n").alias("most"),
        F.when(F.min("component") == F.max("component"), F.min("component")).alias("pure"),
    )
    matrix = (
        members.select("row", F.explode("shared").alias("token")).join(labels.select("row", "group"), "row")
        .select("token", "group").distinct().join(whole, "group")
    )
    asks = members.select("row", F.explode("asks").alias("token")).join(labels.drop("group"), "row")
    lower = F.ceil(F.col("n") * percent / 100)
    met = (
        (F.col("n") >= F.col("least")) & (lower <= F.col("most"))
        & (F.col("pure").isNull() | (F.col("pure") != F.col("component")))
    )
    candidates = staged(
        asks.join(matrix.hint("merge"), "token").where(met).select("row", "n", "component", "group").distinct(), "candidates"
    )
    # Groups that many sets ask are opened several times, for some of them each.
    shares = candidates.groupBy("group").agg(
        F.ceil(F.sum("n") / (4 * GROUP_TOKENS)).cast("int").alias("shares")
    )
    asking = (
        candidates.join(shares, "group")
        .withColumn("share", F.pmod(F.xxhash64("row"), F.col("shares")).cast("int"))
        .join(members.select("row", "tokens"), "row")
        .select("group", "share", "row", "component", "tokens")
    )
    opened = (
        labels.join(shares, "group").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .join(members.select("row", "tokens"), "row")
        .select("group", "share", "row", "n", "component", "tokens")
    )
    opened = opened.toDF(*opened.columns)
    found = asking.groupBy("group", "share").cogroup(opened.groupBy("group", "share")).applyInArrow(
        _between(percent), _LINKS
    )
    return staged(known.union(found), "links")


def _named(docs: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The staged ``prefixes`` of documents, and (digest, component_id) of their distinct sets."""
    rows = staged(prefixes(docs, length, percent), "prefixes")
    found = staged(live(rows, percent), "live")
    first = found.groupBy("digest").agg(F.min("row").alias("row"))
    distinct = found.join(first, ["digest", "row"])
    ids = distinct.select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    # One row per digest: an id may have several texts, and several rows one text.
    sets = _sets(texts, length).groupBy("digest").agg(F.first("tokens").alias("tokens"))
    members = staged(
        distinct.join(sets, "digest").select("row", "n", "digest", "asks", "shared", "middle", "tokens"), "members"
    )
    labels = staged(components(links(members, percent)), "labels").withColumnRenamed("node", "row")

    by_digest = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    linked = members.select("row", "digest").join(labels, "row").select("digest", "component")
    found = by_digest.join(linked, "digest", "left")
    least = found.where("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    named = staged(
        found.join(least, "component", "left").select("digest", F.coalesce("component_id", "least").alias("component_id")),
        "named",
    )
    return rows, named


def joined(docs: DataFrame, length: int = LENGTH, percent: int = PERCENT) -> DataFrame:
    """One row (doc_id, n, component_id) per row of ``docs`` (doc_id, text; others aren't read).

    ``n`` is the number of distinct n-grams, ``component_id`` the smallest doc_id that links lead to:
    two documents are linked if of the n-grams of either, ``percent`` in a hundred are in both. Null
    texts and those without words have no n-grams and no links. Null ids count as none; rows that
    repeat come as often. N-grams are told apart by 64-bit names, equal sets by 128-bit digests.
    """
    with shuffles_released(docs.sparkSession):
        rows, named = _named(docs, length, percent)
    return rows.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the size of their set and the smallest doc_id of their component."""
    return joined(documents(spark, sf_dir)).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )
