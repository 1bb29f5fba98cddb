"""Byte-level BPE encoding and decoding by recursive queries.

Each task cuts its texts into parts and hands the distinct ones it hasn't met to DuckDB, in blocks
of bounded size. A recursive query starts with one row per byte of a word, joins neighbouring
rows with the merge table, and contracts the leftmost pair of least rank of each word, until no
word has a pair left. Long words are contracted in rounds instead, each of which starts from the
table of the one before and contracts many pairs. Decoding joins all ids of the texts with the vocabulary
and puts the bytes of each text together by an aggregate in order.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from sitewind.llm.common import documents
from sitewind.llm.pieces import Remembered

#: Words of one recursive query, and bytes, of which the first word may have more.
WORDS_AT_ONCE = 40_000
BYTES_AT_ONCE = 400_000
#: Rows that the steps of a recursive query may hold in all, n * n / 2 for a word of n bytes, and the
#: bytes from which a word is contracted in rounds.
ROWS_AT_ONCE = 4_000_000
LONG = 256
#: Rows of a batch, at most, and bytes of text after which it ends.
TEXT_AT_ONCE = 8 << 20
#: Ids of one decoding query; a text may go on in the next.
IDS_AT_ONCE = 400_000

# A row is a token: its word, where in the word it begins, its id and its length in bytes. A pair's
# key is its rank, place and length in one number (20, 34 and 10 bits), so the least key of a word
# is its leftmost pair of least rank.
_ENCODE = """
with recursive tokens as (
    select word, pos, id, len, 0 as step from start
    union all (
        with best as (
            select a.word, min((m.id::bigint << 44) + (a.pos::bigint << 10) + m.len) as key
            from tokens a join tokens b on b.word = a.word and b.pos = a.pos + a.len
            join merges m on m.l = a.id and m.r = b.id
            group by a.word),
        chosen as (
            select word, (key >> 44)::int as id, ((key >> 10) & 17179869183)::int as pos,
                (key & 1023)::int as len
            from best)
        select t.word, t.pos,
            case when t.pos = c.pos then c.id else t.id end,
            case when t.pos = c.pos then c.len else t.len end,
            step + 1
        from tokens t join chosen c on c.word = t.word
        where t.pos <= c.pos or t.pos >= c.pos + c.len))
select t.word, pos, id
from tokens t join (select word, max(step) as step from tokens group by word) last
    on last.word = t.word and last.step = t.step
order by t.word, pos
"""
# A round contracts, in each word, pairs of the least ranks, as long as no contraction of those can
# make a pair of a lower or equal rank: ``child`` is the least rank that a token can become part of.
# What is new then comes after all of them, and of them, overlaps alone decide. A pair is contracted
# if it comes before both neighbours by (rank, place); of a run of equal ranks, which overlap one by
# one, every other pair from its first on is. Pairs that may still lose theirs to a neighbour wait
# for a later round. If even the least rank can make a lower one, its leftmost pair goes alone.
_ROUND = """
create or replace temp table rounded as
with pairs as materialized (
    select t.word, t.pos, t.id, m.id as rank, m.child
    from (select word, pos, id, lead(id) over (partition by word order by pos) as next from live) t
    left join merges m on m.l = t.id and m.r = t.next),
ranks as (
    select word, rank, child,
        min(child) over (partition by word order by rank rows between unbounded preceding and 1 preceding) as before
    from (select distinct word, rank, child from pairs where rank is not null)),
cuts as (
    select word, min(rank) as least,
        coalesce(min(case when child < rank or rank >= before then rank end), 2147483647) as cut
    from ranks group by word),
candidates as (
    select p.word, p.pos, p.id, c.least = c.cut as alone,
        case when p.rank < c.cut or p.rank = c.least then p.rank end as rank
    from pairs p left join cuts c on c.word = p.word),
neighbours as (
    select *, row_number() over w as n, lag(rank) over w as prev, lead(rank) over w as next
    from candidates window w as (partition by word order by pos)),
runs as (
    select *, min(case when rank is not null then n end) over (partition by word) as leftmost,
        max(case when rank is not null and prev is distinct from rank
            then n * 2 + (case when prev is null or prev > rank then 1 else 0 end) end)
        over (partition by word order by pos rows between unbounded preceding and current row) as begun
    from neighbours),
chosen as (
    select word, pos, id, rank, coalesce(case when alone then rank is not null and n = leftmost
        else rank is not null and begun % 2 = 1 and (n - begun // 2) % 2 = 0 and (next is null or next >= rank)
        end, false) as taken
    from runs)
select word, pos, case when taken then rank else id end as id
from (select *, lag(taken, 1, false) over (partition by word order by pos) as gone from chosen)
where not gone
"""
_DECODE = """
select text, list(token order by pos) as tokens
from ids join vocabulary using (id) group by text order by text
"""


class Codec:
    """Vocabulary of a rank file in a DuckDB database that only its process sees."""

    def __init__(self, rank_file: bytes) -> None:
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in rank_file.splitlines() if line)
        }
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (left, right, rank, len(token))
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None
            and (right := ranks.get(token[at:])) is not None
        ]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        columns = {c: np.array([m[i] for m in merges], np.int32) for i, c in enumerate(("l", "r", "id", "len"))}
        child = np.full(max(ranks.values()) + 1, np.iinfo(np.int32).max, np.int32)
        for side in ("l", "r"):
            np.minimum.at(child, columns[side], columns["id"])
        self._table("merges", pa.table({**columns, "child": child[columns["id"]]}))
        self._table("vocabulary", pa.table({
            "id": pa.array(list(ranks.values()), pa.int32()),
            "token": pa.array(list(ranks), pa.binary()),
        }))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows", rows)
        self.db.execute(f"create table {name} as select * from rows")
        self.db.unregister("rows")

    def _query(self, name: str, rows: pa.Table, sql: str) -> dict[str, np.ndarray]:
        self.db.register(name, rows)
        found = self.db.execute(sql).fetchnumpy()
        self.db.unregister(name)
        return found

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. A word that is a token itself is that token, as the pattern's users
        have it; no word may be empty."""
        found: list = [None] * len(words)
        block: list[int] = []
        long: list[int] = []
        size = rows = long_size = 0
        for at, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                found[at] = np.array([rank], np.int32)
                continue
            if len(word) >= LONG:
                long.append(at)
                long_size += len(word)
                if long_size >= BYTES_AT_ONCE:
                    self._encode_block(words, long, found, self._rounds)
                    long, long_size = [], 0
                continue
            block.append(at)
            size += len(word)
            rows += len(word) * len(word) // 2
            if len(block) >= WORDS_AT_ONCE or size >= BYTES_AT_ONCE or rows >= ROWS_AT_ONCE:
                self._encode_block(words, block, found, self._recursion)
                block, size, rows = [], 0, 0
        self._encode_block(words, block, found, self._recursion)
        self._encode_block(words, long, found, self._rounds)
        return found

    def _recursion(self, start: pa.Table) -> dict[str, np.ndarray]:
        return self._query("start", start, _ENCODE)

    def _rounds(self, start: pa.Table) -> dict[str, np.ndarray]:
        self.db.register("start", start)
        self.db.execute("create or replace temp table live as select word, pos, id from start")
        self.db.unregister("start")
        held = start.num_rows
        while True:
            self.db.execute(_ROUND)
            left = self.db.execute("select count(*) from rounded").fetchone()[0]
            if left == held:
                break
            held = left
            self.db.execute("drop table live")
            self.db.execute("alter table rounded rename to live")
        found = self.db.execute("select word, pos, id from live order by word, pos").fetchnumpy()
        self.db.execute("drop table live")
        self.db.execute("drop table rounded")
        return found

    def _encode_block(self, words: list[bytes], block: list[int], found: list, run: Callable) -> None:
        if not block:
            return
        sizes = np.array([len(words[at]) for at in block])
        whole = np.frombuffer(b"".join(words[at] for at in block), np.uint8)
        starts = np.cumsum(sizes) - sizes
        rows = run(pa.table({
            "word": np.repeat(np.arange(len(block), dtype=np.int32), sizes),
            "pos": (np.arange(len(whole)) - np.repeat(starts, sizes)).astype(np.int32),
            "id": self.byte[whole],
            "len": np.ones(len(whole), np.int32),
        }))
        cuts = np.searchsorted(rows["word"], np.arange(1, len(block)))
        for at, ids in zip(block, np.split(np.asarray(rows["id"], np.int32), cuts), strict=True):
            found[at] = ids

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of each text's ids: the texts' ids one after the other, and where each text's end."""
        texts = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
        found: list[list[bytes]] = [[] for _ in ends]
        for at in range(0, len(ids), IDS_AT_ONCE):
            block = ids[at : at + IDS_AT_ONCE]
            self.db.register("ids", pa.table({
                "text": texts[at : at + IDS_AT_ONCE], "pos": np.arange(len(block), dtype=np.int32), "id": block,
            }))
            rows = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("ids")
            joined = pa.compute.binary_join(rows.column("tokens").cast(pa.list_(pa.binary())), b"")
            for text, part in zip(rows.column("text").to_pylist(), joined.to_pylist(), strict=True):
                found[text].append(part)
        return [b"".join(parts) for parts in found]

    def codes(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed."""
        return [i.tobytes() for i in self.encode_words(words)]


@cache
def _codec(rank_file: bytes) -> Codec:
    return Codec(rank_file)


@cache
def _memory(rank_file: bytes, remembered: int | None = None) -> Remembered:
    return Remembered(_codec(rank_file).codes, b"", remembered)


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, at_once: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``at_once`` bytes, or of one longer row."""
    at, ends = 0, np.cumsum(sizes)
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + at_once, "right")))
        yield batch.slice(at, end - at)
        at = end


def encoded(
    docs: DataFrame, rank_file: bytes, remembered: int | None = None, at_once: int = TEXT_AT_ONCE
) -> DataFrame:
    """``docs`` with the ids of each text (``ids``, ARRAY<INT>) and the bytes that those ids decode
    to (``decoded``, BINARY). Columns of these names are replaced. A null or an empty text has no
    ids. A vocabulary that doesn't give back what went in is an error. ``rank_file`` is a rank file's content; it goes to the tasks, so they need no such file.
    ``remembered`` bounds the parts that a worker keeps encoded, by default as ``pieces`` does, and
    ``at_once`` the bytes of text it takes together: the ids are the same, less takes less memory and
    more time.
    """
    kept = [c for c in docs.columns if c not in ("ids", "decoded", "_text")]
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, memory = _codec(shared.value), _memory(shared.value, remembered)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("_text")).to_numpy(zero_copy_only=False)
            for part in _slices(batch, sizes, at_once):
                each = [b"".join(code) for code in memory.codes(part.column("_text").to_pylist())]
                ids = np.frombuffer(b"".join(each), np.int32)
                ends = np.cumsum([0, *(len(i) // 4 for i in each)]).astype(np.int32)
                decoded = pa.array(codec.decode(ids, ends[1:]), pa.binary())
                if not decoded.equals(part.column("_text").cast(pa.binary())):
                    raise ValueError("the rank file doesn't decode to what it encodes")
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in kept],
                        pa.ListArray.from_arrays(ends, ids),
                        decoded,
                    ],
                    [*kept, "ids", "decoded"],
                )

    schema = docs.select(*kept).schema.add("ids", ArrayType(IntegerType())).add("decoded", BinaryType())
    rows = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    return rows.mapInArrow(encode, schema)


def digests(coded: DataFrame) -> list:
    """What the ids and the decoded bytes come down to, as columns."""
    return [
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ]


def rank_file(path: str | None = None) -> bytes:
    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read()


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a digest of their ids, and of the bytes that those decode to."""
    coded = encoded(documents(spark, sf_dir).select("doc_id", "text"), rank_file())
    return coded.select("doc_id", *digests(coded))
