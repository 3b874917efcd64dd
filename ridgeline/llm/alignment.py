"""Alignment of two tokenizers over a corpus: groups between common borders, links of overlapping tokens, pair counts.

A text is encoded by both sides and their tokens' bytes laid side by side. Places where tokens of both end cut it into
groups; each stretch between two neighbouring ends, of whichever side, is one link of the A and the B token there.

Pair counts cover the corpus, and each document wants them for its own pairs. Documents give their pairs out as
postings by B id, with how often each holds them: one row a B id and block of documents, three arrays. Postings
travel to their B id in sorted streams that Spark spills; there the counts of the B id's pairs stand before its
postings (a cogroup in one stream), so that counts, their highest and each document's share are settled locally. What
each document got is summed by document.

Blocks are dealt into groups and B ids into BINS bins, and what is in one group and bin is a stream of its own, of
about CELL postings. So a document's shares come from BINS streams at most, however large the corpus is. A frequent B
id is in most documents: it is cut into slices by block, each of about a bin's share at most, which go to bins of their
own. Its counts have at most one row for each A id and go to each slice. Counts are summed by pair beforehand, in the
tasks that hold postings before they travel. The table of slices has at most one row for each B id and is broadcast;
vocabularies beyond MOST_IDS are refused.

Cases: texts null, empty, or changed by a tokenizer (bytes of its tokens other than a space and the text) have no
tokens: all counts zero and an empty digest. Repeated rows count each and get their own row. Long texts are read whole
and are a block of their own (some 150 bytes of memory a byte). An empty table gives an empty table. Columns not in keep are left out; one in keep with
the name of an output column is an error (see shared.boxed).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.bpe import Encoder, encoder
from ridgeline.llm.bpe import vocabulary as byte_vocabulary
from ridgeline.llm.pieces import Pieces, pieces_of
from ridgeline.llm.shared import flat, map_texts, on_workers, parts_for, schema_of, written

#: Ids of either side at most: two fit into one number beside a document's place in its block.
MOST_IDS = 1 << 20
#: Bytes of text in a block of documents; bins of B ids; postings of a group's bin; postings settled at a time; document shares held before they are summed.
BLOCK_BYTES, BINS, CELL, AT_A_TIME, HELD = 2 << 20, 16, 1 << 20, 1 << 19, 1 << 21
COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Sides:
    """Both encoders, the length of each token's bytes, and the tokens' names with what can follow them in a digest."""

    def __init__(self, a_path: str, a_ranks: str | None, b_path: str):
        self.a: Encoder = encoder(a_path, a_ranks)
        self.b: Pieces = pieces_of(b_path)
        self.a_bytes, names = byte_vocabulary(a_path)
        self.b_bytes = self.b.bytes_of
        if max(len(self.a_bytes), len(self.b_bytes)) > MOST_IDS:
            raise ValueError(f"at most {MOST_IDS} ids a side")
        self.a_size, self.b_size = (np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes))
        self.spellings = [(np.frombuffer(b"".join(of), np.uint8), np.cumsum(size) - size, size) for of, size in ((self.a_bytes, self.a_size), (self.b_bytes, self.b_size))]
        self.a_named = [n + end for n in names for end in ",|"]
        self.b_named = [n + end for n in self.b.names for end in ",;"]
        self.named = self.a_named + self.b_named

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(tokens a text, ids of all texts one after the other) of both sides; a text has none where the bytes of either's tokens
        aren't a space and the text. Bytes are compared for all texts at once."""
        raw = [b" " + t.encode() if t else b"" for t in texts]
        size = np.array([len(x) for x in raw], np.int64)
        found = []
        for encode, dtype in ((lambda t: self.a.plain(" " + t), self.a.dtype), (self.b.encode, np.dtype(np.int32))):
            own = [encode(t) if t else b"" for t in texts]
            found.append((np.array([len(x) for x in own], np.int64) // dtype.itemsize, np.frombuffer(b"".join(own), dtype).astype(np.int64)))
        same = np.ones(len(texts), bool)
        for (n, ids), of in zip(found, (self.a_size, self.b_size), strict=True):
            same &= np.diff(np.append(0, np.cumsum(of[ids]))[np.cumsum(n)], prepend=0) == size
        found = self.without(found, same)
        kept = np.flatnonzero(same)
        want, last = np.frombuffer(b"".join([raw[k] for k in kept.tolist()]), np.uint8), np.cumsum(size[kept])
        for (_, ids), spelling in zip(found, self.spellings, strict=True):
            other = np.flatnonzero(spelled(ids, *spelling) != want)
            same[kept[np.searchsorted(last, other, "right")]] = False
        return self.without(found, same)

    @staticmethod
    def without(found: list[tuple[np.ndarray, np.ndarray]], same: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return found if same.all() else [(np.where(same, n, 0), ids[np.repeat(same, n)]) for n, ids in found]


def spelled(ids: np.ndarray, raw: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of ids one after the other; raw holds those of the vocabulary, each id's from its start."""
    n = size[ids]
    ends = np.cumsum(n)
    return raw[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - ends + n, n)]


@lru_cache(maxsize=1)
def sides(a_path: str, a_ranks: str | None, b_path: str) -> Sides:
    """One a worker."""
    return Sides(a_path, a_ranks, b_path)


def below(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of ends lie below each of at, as searchsorted says; both are places in one block's bytes, so they are counted up."""
    return np.cumsum(np.bincount(ends + 1, minlength=int(at.max(initial=0)) + 1))[at]


class Block:
    """The alignment of some texts as arrays: tokens, ends, groups and links of all of them one after the other."""

    def __init__(self, of: Sides, texts: list[str]):
        (self.n_a, a), (self.n_b, b) = of.ids(texts)
        ends_a, ends_b = np.cumsum(of.a_size[a]), np.cumsum(of.b_size[b])  # texts are as long on both sides, so they stay level
        common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        last_a, last_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        self.n_groups = np.diff(np.searchsorted(at_a, last_a), prepend=0)
        both = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")  # two runs that only need merging
        ends = both[np.diff(both, prepend=-1) > 0]  # a link ends at each
        link_a, link_b = below(ends_a, ends), below(ends_b, ends)
        self.doc = np.searchsorted(last_a, link_a, "right")
        self.n_links = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.a, self.b = a[link_a], b[link_b]
        self.shas = self.digests(of, a, b, common, at_a, at_b, ends_a, ends_b, last_a + last_b)

    def digests(self, of: Sides, a, b, common, at_a, at_b, ends_a, ends_b, last) -> list[str]:
        """sha256 of each text's groups: a group's A ids, then its B ids. A group's tokens move as one, so a token's place
        is its own number and how many of the other side go before it."""
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[at_a] = closes_b[at_b] = 1
        group_a, group_b = below(common, ends_a), below(common, ends_b)
        before_a = np.concatenate(([0], at_b + 1))[group_a]  # B tokens of earlier groups
        before_b = (at_a + 1)[group_b] if len(at_a) else group_b  # A tokens up to this group's end
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + before_a] = 2 * a + closes_a
        codes[np.arange(len(b)) + before_b] = 2 * b + closes_b + len(of.a_named)
        codes, named, out, lo = codes.tolist(), of.named, [], 0
        for hi in last.tolist():
            out.append(hashlib.sha256("".join([named[c] for c in codes[lo:hi]])[:-1].encode()).hexdigest() if hi > lo else "")
            lo = hi
        return out

    def postings(self) -> tuple[np.ndarray, ...]:
        """(b, doc, a, n) of the distinct pairs of each text, by b, then a, then text."""
        key, n = np.unique(self.b << 40 | self.a << 20 | self.doc, return_counts=True)
        return key >> 40, key & 0xFFFFF, key >> 20 & 0xFFFFF, n


def as_lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values.astype(np.int32)))


def blocks(docs: DataFrame, keep: list[str], a_path: str, a_ranks: str | None, b_path: str, text_col: str) -> DataFrame:
    """Rows of two kinds: a text's own counts and digest (b null), and postings of a B id in a block of texts (row is
    the block's first; docs counts from there)."""
    schema = schema_of(docs, keep, f"row long, {COLUMNS}, b int, docs array<int>, a array<int>, n array<int>")

    def make() -> Callable[[pa.RecordBatch], dict]:
        of = sides(a_path, a_ranks, b_path)

        def f(piece: pa.RecordBatch) -> dict:
            data, off = flat(piece.column(text_col))
            raw = data.tobytes()
            block = Block(of, [raw[off[k] : off[k + 1]].decode("utf-8") for k in range(piece.num_rows)])
            b, doc, a, n = block.postings()
            starts = np.flatnonzero(np.diff(b, prepend=-1))
            rows, more = piece.num_rows, len(starts)
            first = piece.column("row")[0].as_py()
            own = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(more, kind)])
            listed = lambda x: pa.concat_arrays([pa.nulls(rows, pa.list_(pa.int32())), as_lists(x, starts)])
            return {c: pa.concat_arrays([piece.column(c), pa.nulls(more, piece.column(c).type)]) for c in keep} | {
                "row": pa.concat_arrays([piece.column("row"), pa.array(np.full(more, first, np.int64))]),
                "n_a": own(block.n_a, pa.int64()), "n_b": own(block.n_b, pa.int64()), "n_groups": own(block.n_groups, pa.int64()), "n_links": own(block.n_links, pa.int64()), "groups_sha256": own(block.shas, pa.string()),
                "b": pa.concat_arrays([pa.nulls(rows, pa.int32()), pa.array(b[starts].astype(np.int32))]), "docs": listed(doc), "a": listed(a), "n": listed(n),
            }

        return f

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), *(F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])))
    return map_texts(numbered, ["row", *keep, text_col], schema, make, text_col, BLOCK_BYTES)


def shares(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, n_best, count_sum) of postings that follow the counts of their B id, in rows (row, docs, a, n); counts have no docs."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    known_a, known_n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the counts that the last rows stood under
    for batch in few_at_a_time(stream):
        docs, a_lists, n_lists = (batch.column(c) for c in ("docs", "a", "n"))
        is_count = np.asarray(docs.is_null())
        a, n = (np.asarray(x.flatten()).astype(np.int64) for x in (a_lists, n_lists))
        of_row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(a_lists.offsets)))
        head, counts = np.cumsum(is_count)[of_row], is_count[of_row]  # head 0: the counts carried over
        table, number = np.concatenate((known_a, head[counts] << 20 | a[counts])), np.concatenate((known_n, n[counts]))
        highest = np.zeros(int(is_count.sum()) + 1, np.int64)
        np.maximum.at(highest, table >> 20, number)
        under, links = head[~counts], n[~counts]
        count = number[np.searchsorted(table, under << 20 | a[~counts])]
        rows = np.asarray(batch.column("row").fill_null(0))[of_row[~counts]] + np.asarray(docs.flatten())
        held.append((rows, np.where(count == highest[under], links, 0), links * count))
        size += len(rows)
        tail = table >> 20 == len(highest) - 1
        known_a, known_n = table[tail] & 0xFFFFF, number[tail]
        if size >= HELD:
            yield summed(held)
            held, size = [], 0
    if size:
        yield summed(held)


def few_at_a_time(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about AT_A_TIME postings."""
    for batch in stream:
        ends = np.asarray(batch.column("a").offsets)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + AT_A_TIME, "right")) - 1)
            yield batch.slice(lo, min(hi, batch.num_rows) - lo)
            lo = hi


def summed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    row, best, total = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(row, kind="stable")
    row = row[order]
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    add = lambda x: np.add.reduceat(x[order], starts) if len(starts) else x
    return pa.RecordBatch.from_pydict({"row": row[starts], "n_best": add(best), "count_sum": add(total)})


def aligned(docs: DataFrame, keep: list[str], a_path: str, b_path: str, a_ranks: str | None = None, text_col: str = "text") -> DataFrame:
    """keep, and n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose pair is its B id's most frequent in the corpus) and count_sum (their pairs' counts)."""
    spark = docs.sparkSession
    schema_of(docs, keep, "row long, b int, docs int, a int, n int, n_best long, count_sum long, " + COLUMNS)
    table = written(blocks(docs, keep, a_path, a_ranks, b_path, text_col), "aligned")
    own, postings = table.where("b is null").select("row", *keep, *(c.split()[0] for c in COLUMNS.split(", "))), table.where("b is not null").select("b", "row", "docs", "a", "n")
    by_pair = postings.select("b", F.inline(F.arrays_zip("a", "n"))).groupBy("b", "a").agg(F.sum("n").cast("long").alias("n"), F.count(F.lit(1)).alias("held"))
    by_id = written(by_pair.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("a", "n"))).alias("pairs"), F.sum("held").alias("held")), "counts")
    total = by_id.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    cells = parts_for(spark, total, CELL)
    groups = -(-cells // BINS)
    slices = by_id.select("b", F.greatest(F.lit(1), F.ceil(F.col("held") * BINS / max(total, 1))).cast("int").alias("slices"))
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    heads = by_id.join(F.broadcast(slices), "b").withColumn("slice", F.explode(up_to(F.col("slices")))).withColumn("group", F.explode(up_to(F.lit(groups))))
    heads = heads.select("b", "slice", "group", F.lit(None).cast("long").alias("row"), F.lit(None).cast("array<int>").alias("docs"), F.col("pairs.a").alias("a"), F.col("pairs.n").alias("n"))
    dealt = postings.join(F.broadcast(slices), "b").select("b", F.pmod(F.xxhash64("row", F.lit(1)), F.col("slices")).cast("int").alias("slice"), F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), "row", "docs", "a", F.col("n").cast("array<bigint>").alias("n"))
    on_workers(spark)
    both = heads.unionByName(dealt).withColumn("bin", F.pmod(F.xxhash64("b", "slice"), F.lit(BINS)).cast("int"))
    streams = both.repartition(cells, "group", "bin").sortWithinPartitions("group", "bin", "b", "slice", F.col("row").asc_nulls_first())
    got = streams.mapInArrow(shares, "row long, n_best long, count_sum long").groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return own.join(got, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])
