"""SimHash fingerprints and all links between them within a radius, compared bit-sliced.

A fingerprint of 64 bits has bit j where over half of the shingles' XXH64 hashes have it. Two fingerprints
within 4 bits agree in one of 5 parts of their bits at least, so each meets those with an equal part. The
comparison holds a group's fingerprints as 64 vertical bit planes, 64 of them to a machine word: a word of
distances is three carry-save counters and an overflow word, and a block of words is left as soon as all its
lanes exceed the radius.

Equal fingerprints are one row before any of this. A part that too many fingerprints share is refined by parts
of the remaining bits, again one more than the radius, which loses no pair. A group gives out a spanning
forest of its links, never all pairs. So a group of copies costs its distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.components import components
from ridgeline.llm.shared import map_texts, on_workers, parts_for, schema_of, written

U = np.uint64
BITS = 64
#: A group of more fingerprints than this is refined by more bits.
REFINE_OVER = 4096


def fingerprint(text: bytes, n: int = 4, seed: int = 42) -> int:
    """As op4 wants it: A-Z lower-cased, white-space words, n-word shingles with repeats."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
        joined, starts, ends = shingles[0], [0], [len(shingles[0])]
    else:
        joined = b" ".join(words)
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[: len(ends) - n])]
        ends = ends[n - 1 :]
    h = xxhash.xxh64_digest
    bits = np.unpackbits(np.frombuffer(b"".join([h(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)]), np.uint8)).reshape(-1, BITS)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], n: int = 4, seed: int = 42, text_col: str = "text") -> DataFrame:
    """The columns of keep, and fp long: the fingerprint's 64 bits as a signed number."""

    def make():
        def f(piece: pa.RecordBatch) -> dict:
            out = {c: piece.column(c) for c in keep}
            col = piece.column(text_col)
            out["fp"] = np.array([fingerprint(b"" if t is None else t.encode(), n, seed) for t in col.to_pylist()], U).view(np.int64)
            return out

        return f

    return map_texts(docs, [*keep, text_col], schema_of(docs, keep, "fp long"), make, text_col)


def within(fps: np.ndarray, group: np.ndarray, radius: int = 4, chunk: int = 1 << 19) -> Iterator[tuple[int, np.ndarray]]:
    """(i, later members of i's group within the radius of i), for each i that has any. fps lie group by group.

    A fingerprint is a number, or a row of numbers where it has more bits than one.
    """
    n = len(fps)
    if n < 2:
        return
    fps = fps.reshape(n, -1)
    bits = fps.shape[1] * BITS
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(head, n))
    many = np.repeat(size > 1, size)
    in_group = np.arange(n) - np.repeat(head, size)
    n_words = -(-size // 64)
    first_word = np.concatenate([[0], np.cumsum(n_words)])
    word = np.repeat(first_word[:-1], size) + in_group // 64
    lane = in_group % 64
    row_of = np.full((first_word[-1], 64), -1, np.int64)
    row_of[word, lane] = np.arange(n)
    planes = []
    for k in range(fps.shape[1]):
        lanes = np.where(row_of >= 0, fps[row_of, k], U(0))
        planes += [np.packbits(((lanes >> U(j)) & U(1)).astype(bool), axis=1, bitorder="little").view(U).ravel() for j in range(BITS)]
        del lanes
    valid = np.packbits(row_of >= 0, axis=1, bitorder="little").view(U).ravel()
    last_word = np.repeat(first_word[1:], size)
    reps = np.where(many, last_word - word, 0)
    done = np.concatenate([[0], np.cumsum(reps)])
    n_counters = max(radius.bit_length(), 1)
    lo = 0
    while lo < n:
        hi = max(int(np.searchsorted(done, done[lo] + chunk, "right")) - 1, lo + 1)
        r = np.repeat(np.arange(lo, hi), reps[lo:hi])
        w = np.arange(len(r)) - np.repeat(done[lo:hi] - done[lo], reps[lo:hi]) + word[r]
        live = valid[w].copy()
        own = w == word[r]  # in its own word only the lanes after its own
        live[own] &= ~((U(2) << lane[r[own]].astype(U)) - U(1))
        lo = hi
        q = fps[r]
        counters, over = [np.zeros(len(r), U) for _ in range(n_counters)], np.zeros(len(r), U)
        for j in range(bits):
            d = planes[j][w] ^ (U(0) - ((q[:, j // BITS] >> U(j % BITS)) & U(1)))
            for k in range(n_counters):
                d, counters[k] = counters[k] & d, counters[k] ^ d
            over |= d
            if j % 4 == 3 and j > 2 * radius or j == bits - 1:
                beyond, equal = over.copy(), ~over
                for k in reversed(range(n_counters)):
                    if radius >> k & 1:
                        equal &= counters[k]
                    else:
                        beyond |= equal & counters[k]
                        equal &= ~counters[k]
                live &= ~beyond
                stay = live != 0
                if j == bits - 1 or stay.mean() < 0.8:
                    r, w, q, live, over = (x[stay] for x in (r, w, q, live, over))
                    counters = [x[stay] for x in counters]
                    if not len(r):
                        break
        if len(r):
            cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            for a, b in zip(cut, np.append(cut[1:], len(r)), strict=True):
                hit = np.unpackbits(live[a:b].view(np.uint8), bitorder="little").astype(bool)
                yield int(r[a]), row_of[w[a:b]].ravel()[hit]


def forest(n: int, near: Iterator[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for every member of a component of two or more; the root is its first member."""
    root = np.arange(n)

    def top(x: np.ndarray) -> np.ndarray:
        up = root[x]
        while True:
            next_up = root[up]
            if (next_up == up).all():
                root[x] = up
                return up
            up = next_up

    for i, others in near:
        tops = np.unique(top(np.append(others, i)))
        if len(tops) > 1:
            root[tops] = tops[0]
    top(np.arange(n))
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def _parts(width: int, n: int) -> list[tuple[int, int]]:
    cut = [width * i // n for i in range(n + 1)]
    return list(zip(cut[:-1], cut[1:], strict=True))


def links(fps: DataFrame, radius: int = 4, refine_over: int = REFINE_OVER) -> DataFrame:
    """(u, v): links that connect all distinct fingerprints of fps (fp long) as those within the radius do."""
    spark = fps.sparkSession
    on_workers(spark)
    if not 0 <= radius < 8:
        raise ValueError("radius must be from 0 to 7")

    def find(table: pa.Table) -> pa.Table:
        # a path names the parts chosen so far, a key their bits; a bucket holds many groups
        key = np.array(table.column("key").combine_chunks().to_numpy(zero_copy_only=False))
        fp = np.array(table.column("fp").combine_chunks().to_numpy(zero_copy_only=False))
        order = np.lexsort((fp, key))
        key, fp = key[order], fp[order]
        member, root = forest(len(fp), within(fp.view(U), key, radius))
        return pa.table({"u": fp[member], "v": fp[root]})

    mask = lambda x, lo, hi: F.shiftrightunsigned(x, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
    state = fps.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    out, width, depth = None, BITS, 0
    while True:
        wide = _parts(width, radius + 1)
        least = width - max(hi - lo for lo, hi in wide)
        choice = []
        for i, (lo, hi) in enumerate(wide):
            rest = mask(F.col("rest"), 0, lo) if lo else F.lit(0).cast("long")
            if hi < width:
                rest = rest.bitwiseOR(F.shiftleft(mask(F.col("rest"), hi, width), lo))
            choice.append(F.struct(F.xxhash64("key", F.lit(depth * 16 + i), mask(F.col("rest"), lo, hi)).alias("key"), rest.alias("rest"), F.lit(width - (hi - lo)).alias("left")))
        keyed = state.select("fp", F.explode(F.array(*choice)).alias("c")).select("fp", "c.*")
        # parts differ by a bit in width: the remaining bits are taken as the fewest that any choice leaves
        keyed = keyed.select("fp", "key", "rest")
        width, depth = least, depth + 1
        last = width <= 2 * (radius + 1) or depth > 4
        table = written(keyed, "parts")
        hot = None if last else written(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > refine_over).select("key"), "hot")
        if hot is not None and hot.isEmpty():
            hot = None
        cold = table if hot is None else table.join(hot, "key", "left_anti")
        n = parts_for(spark, table.count(), 200_000)
        found = cold.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(n)).cast("int")).repartition(n, "bucket").groupBy("bucket").applyInArrow(find, "u long, v long")
        out = found if out is None else out.union(found)
        if hot is None:
            return out
        state = table.join(hot, "key", "left_semi")


def grouped(docs: DataFrame, id_col: str = "doc_id", n: int = 4, seed: int = 42, radius: int = 4, text_col: str = "text") -> DataFrame:
    """(id_col, fp long, component): every row once; component is the smallest id that links reach.

    A text without words has fingerprint 0 and links like any other; one with fewer words than a shingle is
    one shingle. A null text is empty. A row with a null id takes its component from the others, null if
    none has an id. Rows may repeat. An empty table gives an empty table.
    """
    table = written(fingerprints(docs, [id_col], n, seed, text_col), "fingerprints")
    distinct = written(table.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    reached = components(links(distinct.select("fp"), radius))
    joined = written(distinct.join(reached, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("root")), "joined")
    least = written(joined.groupBy("root").agg(F.min("first").alias("component")), "roots")
    of_fp = written(joined.join(least, "root").select(F.col("fp").alias("of"), "component"), "classes")
    return table.join(of_fp, F.col("fp") == F.col("of")).select(id_col, "fp", "component")
