"""SimHash groups of near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one row before anything else. Candidates come from minwise hashes, ROWS to a band: two sets of
similarity s share a band with a chance of 1 - (1 - s**ROWS)**BANDS, so a pair at 0.8 has none with a chance of
4e-9. Bands only say which texts meet, and they meet within a band, never in what bands connect: on a large corpus
bands connect everything. What meets is compared bit-sliced, by fingerprints of two kinds. Of the SimHash fingerprint's
128 bits one differs with a chance of 0.1875 at most in a pair at 0.8 (five shingles against four of them; 0.15 in long
texts), so such a pair is beyond RADIUS bits with a chance of 3e-9 at most. Of the sketch, one bit of each minwise hash,
a bit differs with a chance of (1 - s) / 2: a pair at 0.8 is beyond NEAR of 384 bits with a chance of 1e-9 (calculated),
one at 0.5 within them with a chance of 2 in 100, one at 0.4 of 2 in 100,000. What passes both makes families, in which the
shingles themselves decide.

Groups, of a band as of a family, are dealt out in tiles of TILE sets. In the first pass each tile meets the group's
center, which settles most of a large group; in the second those that are not joined to the center, in tiles of their
own, meet every tile. So all pairs that could join two groups are compared, a tile gives out a spanning forest of its
links, and no task holds more than two tiles.

Cases: null and empty texts, and those without words, have the empty set and are one group; rows with a null id are
taken as rows of an id that is none, which the pipeline keeps apart beforehand; repeated rows have one set and are no
further work; texts are read whole, and a long one's shingles travel once for each time its family is dealt; an empty table
gives an empty table; columns other than id and text are left out, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.components import components
from ridgeline.llm.shared import flat, map_texts, on_workers, parts_for, schema_of, written
from ridgeline.llm.simhash import within
from ridgeline.llm.textgrid import LOWER, SPACED, Hasher, U, mix, words

ROWS, BANDS, TILE = 6, 64, 1024
#: The least similarity as a ratio of whole numbers.
OVER, UNDER = 4, 5
#: Bits of two fingerprints that may differ before the shingles are compared.
RADIUS = 52
#: Bits of two sketches that may differ before.
NEAR = 78
_RNG = np.random.default_rng(7)
_A = _RNG.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32)
_ODD = _RNG.integers(0, 1 << 64, 64, U) | U(1)


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """The distinct hashes of runs of n words, from the words' hashes; fewer words are one shingle."""
    k = min(n, len(h))
    if not k:
        return np.zeros(0, U)
    total = np.full(len(h) - k + 1, k, U)
    for i in range(k):
        total += mix(h[i : len(h) - k + 1 + i] * _ODD[i])
    return np.unique(mix(total))


def minima(s: np.ndarray) -> np.ndarray:
    """ROWS * BANDS minwise hashes of a set."""
    x, least = s.astype(np.uint32), np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 256):
        np.minimum(least, (x[lo : lo + 256] * _A + _B).min(1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key of each band of minwise hashes."""
    rows = least.reshape(BANDS, ROWS).astype(U)
    key = np.arange(BANDS, dtype=U)
    for j in range(ROWS):
        key = mix(key * _ODD[0] + rows[:, j] + U(1))
    return key.view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """One bit of each minwise hash, in numbers of 64."""
    return np.packbits((mix(least.astype(U)) & U(1)).astype(bool)).view(U)


def _sets(piece: pa.RecordBatch, text_col: str, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Each text's shingles, and a number that stands for the set."""
    data, off = flat(piece.column(text_col))
    low = LOWER[data]
    starts, ends, first = words(low, off, SPACED)
    h = Hasher(low).spans(starts, ends)
    sets = [shingles(h[a:b], n) for a, b in zip(first[:-1], first[1:], strict=True)]
    return sets, np.array([mix(mix(s.copy()).sum(dtype=U)[None] + U(len(s)))[0] for s in sets], U).view(np.int64)


def shingled(docs: DataFrame, id_col: str, n: int = 5, text_col: str = "text") -> DataFrame:
    """(id_col, d, keys, marks): d stands for the set of shingles; marks are its fingerprint and sketch. An empty set has neither keys nor marks."""

    def make():
        def f(piece: pa.RecordBatch) -> dict:
            sets, d = _sets(piece, text_col, n)
            least = [minima(s) if len(s) else None for s in sets]
            keys = [band_keys(x) if x is not None else np.zeros(0, np.int64) for x in least]
            marks = [np.concatenate((fingerprint(s), sketch(x))).tobytes() if x is not None else b"" for s, x in zip(sets, least, strict=True)]
            return {id_col: piece.column(id_col), "d": d, "keys": pa.array(keys, pa.list_(pa.int64())), "marks": pa.array(marks, pa.binary())}

        return f

    return map_texts(docs, [id_col, text_col], schema_of(docs, [id_col], "d long, keys array<long>, marks binary"), make, text_col)


def _worded(texts: DataFrame, n: int = 5, text_col: str = "text") -> DataFrame:
    """(d, c, tiles, what) of the rows (d, c, tiles, text) whose text has the set d; what is its hashes in order."""

    def make():
        def f(piece: pa.RecordBatch) -> dict:
            sets, d = _sets(piece, text_col, n)
            own = pa.array(d == piece.column("d").to_numpy())
            words = pa.array([s.tobytes() for s in sets], pa.binary())
            return {c: x.filter(own) for c, x in (("d", piece.column("d")), ("c", piece.column("c")), ("tiles", piece.column("tiles")), ("what", words))}

        return f

    return map_texts(texts, ["d", "c", "tiles", text_col], "d long, c long, tiles int, what binary", make, text_col)


def fingerprint(s: np.ndarray) -> np.ndarray:
    """128 bits of a set in two numbers: a bit is 1 if set in over half of the shingles' hashes."""
    both = np.stack([s, mix(s ^ _ODD[5])])
    ones = np.unpackbits(both.view(np.uint8), axis=1).reshape(2, -1, 64).sum(1, dtype=np.int64)
    return np.packbits(2 * ones > len(s), axis=1).view(U).ravel()


def forest(sets: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root): every set that links of OVER / UNDER or more join to an earlier one of its group, with the first it is joined to.

    sets lie group by group and are not empty. Sets that are joined already are not compared again.
    """
    n = len(sets)
    size, root, tile = np.array([len(s) for s in sets], np.int64), np.arange(n), None
    for i, others in within(np.stack([fingerprint(s) for s in sets]) if n else np.zeros((0, 2), U), group, RADIUS):
        others = others[root[others] != root[i]]
        if not len(others):
            continue
        if tile != group[i]:
            tile, lo, hi = group[i], *np.searchsorted(group, [group[i], group[i] + 1])
            vocabulary, word = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True)
            own = np.split(word, np.cumsum(size[lo:hi])[:-1])
            mark = np.zeros(len(vocabulary), np.int64)
        mark[own[i - lo]] = 1
        starts = np.concatenate([[0], np.cumsum(size[others])[:-1]])
        both = np.add.reduceat(mark[np.concatenate([own[j - lo] for j in others])], starts)
        mark[own[i - lo]] = 0
        joined = root[others[(OVER + UNDER) * both >= OVER * (size[others] + size[i])]]
        if len(joined):
            joined = np.append(joined, root[i])
            at = root[lo:hi]
            at[np.isin(at, joined)] = joined.min()
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def sketch_forest(marks: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) as forest(), of rows of marks whose sketches and fingerprints are within NEAR and RADIUS."""
    root = np.arange(len(marks))
    prints = marks[:, :2]
    for i, others in within(np.ascontiguousarray(marks[:, 2:]), group, NEAR):
        others = others[root[others] != root[i]]
        others = others[np.bitwise_count(prints[others] ^ prints[i]).sum(1) <= RADIUS]
        if len(others):
            joined = np.unique(np.append(root[others], root[i]))
            lo, hi = np.searchsorted(group, [group[i], group[i] + 1])
            at = root[lo:hi]
            at[np.isin(at, joined)] = joined[0]
    member = np.flatnonzero(root != np.arange(len(marks)))
    return member, root[member]


def _found(rows: DataFrame, sketches: bool) -> DataFrame:
    """(u, v): a forest of the links in each task of rows (c, at, tile, d, what), by sketches or by the shingles."""
    spark = rows.sparkSession

    def find(table: pa.Table) -> pa.Table:
        keys = [table.column(x).to_numpy() for x in ("d", "tile", "at", "c")]
        order = np.lexsort(keys)
        d, *own = (k[order] for k in keys)
        fresh = np.ones(len(d), bool)
        fresh[1:] = np.any([k[1:] != k[:-1] for k in own], axis=0)
        group = np.cumsum(fresh)
        fresh[1:] |= d[1:] != d[:-1]
        what = table.column("what").combine_chunks().take(pa.array(order[fresh]))
        data, off = flat(what)
        words = np.frombuffer(data.tobytes(), U)
        if sketches:
            member, root = sketch_forest(words.reshape(-1, 2 + ROWS * BANDS // 64), group[fresh])
        else:
            member, root = forest(np.split(words, off[1:-1] // 8) if len(off) > 1 else [], group[fresh])
        return pa.table({"u": d[fresh][member], "v": d[fresh][root]})

    rows = written(rows.select("c", "at", "tile", "d", "what"), "tiles")
    n = parts_for(spark, rows.count(), TILE * (8 if sketches else 1))
    bucket = F.pmod(F.xxhash64("c", "at", "tile"), F.lit(n)).cast("int").alias("bucket")
    return rows.select("*", bucket).repartition(n, "bucket").groupBy("bucket").applyInArrow(find, "u long, v long")


def _in_groups(rows: DataFrame, tile: int, sketches: bool) -> DataFrame:
    """(u, v): links that connect the sets of each group of rows (c, center, d, tiles, what) as those of all its pairs do. center is one of the group's d."""
    own = rows.withColumn("tile", F.pmod(F.xxhash64("d"), F.col("tiles")).cast("int")).withColumn("at", F.lit(-1))
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    near = written(_found(own.unionByName(own.where("d = center and tiles > 1").withColumn("tile", up_to("tiles"))), sketches), "links")
    large = own.where("tiles > 1")
    if large.isEmpty():
        return near
    root = components(near).select("node", F.col("component").alias("r"))
    rooted = written(large.select("d", "c", "center").join(root, F.col("d") == F.col("node"), "left").select("d", "c", "center", F.coalesce("r", "d").alias("r")), "rooted")
    center = rooted.where("d = center").select(F.col("c").alias("cc"), F.col("r").alias("cr"))
    apart = written(rooted.join(center, (F.col("c") == F.col("cc")) & (F.col("r") != F.col("cr"))).select(F.col("d").alias("a"), F.col("c").alias("ac")), "apart")
    many = apart.groupBy("ac").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts")).select(F.col("ac").alias("pc"), "parts")
    again = large.join(many, F.col("c") == F.col("pc")).withColumn("at", up_to("parts"))
    moved = large.join(apart, (F.col("d") == F.col("a")) & (F.col("c") == F.col("ac"))).join(many, F.col("c") == F.col("pc"))
    moved = moved.withColumn("at", F.pmod(F.xxhash64("d", F.lit(1)), F.col("parts")).cast("int")).withColumn("tile", up_to("tiles"))
    cols = ["c", "at", "tile", "d", "what"]
    return near.union(_found(again.select(*cols).unionByName(moved.select(*cols)), sketches))


def links(table: DataFrame, distinct: DataFrame, docs: DataFrame, id_col: str, text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(u, v): links that connect the sets of table (d, keys) as those of OVER / UNDER or more do. distinct (d, first, marks) names a row of docs for each."""
    on_workers(table.sparkSession)
    keyed = table.select("d", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("d").alias("v"), F.max("d").alias("w")).where("v < w").select(F.col("key").alias("c"), F.col("v").alias("center"))
    shared = written(shared, "bands")
    members = written(keyed.withColumnRenamed("key", "c").join(shared, "c").select("c", "center", "d").distinct(), "members")
    size = members.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    met = members.join(size, "c").join(distinct.select("d", F.col("marks").alias("what")), "d")
    family = written(components(_in_groups(met, tile, True)), "families")
    size = written(family.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")).select(F.col("component").alias("c"), "tiles"), "sizes")
    dealt = family.join(size, F.col("component") == F.col("c")).select("node", "c", "tiles")
    dealt = written(distinct.join(dealt, F.col("d") == F.col("node")).select(F.col("first").alias("_first"), "d", "c", "tiles"), "dealt")
    # only the texts of families are read again; of rows with one id those count whose text has the set
    texts = docs.select(id_col, text_col).join(dealt, F.col(f"`{id_col}`") == F.col("_first"))
    sets = written(_worded(texts, text_col=text_col).withColumn("center", F.col("c")), "sets")
    return _in_groups(sets, tile, False)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(id_col, component): every row once; component is the smallest id that links reach. Texts without words are one group."""
    table = written(shingled(docs, id_col, text_col=text_col), "shingles")
    distinct = written(table.groupBy("d").agg(F.min(id_col).alias("first"), F.min("marks").alias("marks")), "distinct")
    reached = components(links(table, distinct, docs, id_col, text_col, tile))
    joined = written(distinct.join(reached, F.col("d") == F.col("node"), "left").select("d", "first", F.coalesce("component", "d").alias("root")), "joined")
    least = written(joined.groupBy("root").agg(F.min("first").alias("component")), "roots")
    of_d = written(joined.join(least, "root").select(F.col("d").alias("of"), "component"), "classes")
    return table.select(id_col, "d").join(of_d, F.col("d") == F.col("of")).select(id_col, "component")
