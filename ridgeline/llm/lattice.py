"""Near-duplicate vectors by lattice hashing.

A table projects unit vectors to eight numbers by a random matrix and decodes them to the nearest point of E8,
the densest lattice there; the point names the cell. A vector lies at home in its own cell and also probes the
neighbouring cells whose points, among E8's 240 shortest steps, come nearest to it. Two vectors meet in a cell
where one is at home and the other at home or probing; every pair that meets has its cosine taken in double
precision. Several tables with other matrices find what one misses.

A pair that meets in several cells counts in the first alone, which each task works out from the two vectors,
so pairs are never written. Equal vectors are one row with a count before hashing. A cell gives out numbers of
links and a spanning forest. A cell with more than TILE vectors is dealt out in pairs of tiles.

Cells travel without vectors; those with one vector, or none at home, are dropped before vectors are joined.

Cases: null vectors, zero vectors and those with null or non-finite parts link with nothing; vectors of
different lengths never meet; rows may repeat (equal ids are one vector; where it has several values that no smaller
id has, the smallest of them links and the others don't); a null id is left with no links and
a null component; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.components import components
from ridgeline.llm.shared import on_workers, parts_for, written
from ridgeline.llm.simhash import forest
from ridgeline.llm.textgrid import U, mix

TABLES, PROBES, SCALE = 4, 8, 0.9
TILE = 2048


@lru_cache(maxsize=8)
def projection(table: int, dim: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng([seed, table, dim]).normal(size=(dim, 8))


@lru_cache(maxsize=1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    signs = np.array([[0.5 if m >> i & 1 else -0.5 for i in range(8)] for m in range(256) if bin(m).count("1") % 2 == 0])
    return np.concatenate([np.array(out), signs])


def _d8(x: np.ndarray) -> np.ndarray:
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(x[odd] - near[odd]).argmax(1)
    near[odd, worst] += np.where(x[odd, worst] >= near[odd, worst], 1, -1)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """The point of E8 nearest to each row."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def _named(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(points.shape[:-1], table * 1_000_003 + dim, U)
        twice = np.rint(points * 2).astype(np.int64).view(U)
        for k in range(8):
            h = mix(h * U(0x9E3779B97F4A7C15) + twice[..., k])
    return h.view(np.int64)


def cells(unit: np.ndarray, table: int, probes: int = PROBES, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(home, probed): the name of each row's own cell, and of the neighbours it probes."""
    dim = unit.shape[1]
    x = unit @ projection(table, dim) * scale
    point = nearest_point(x)
    steps = shortest()
    best = np.argpartition(-((x - point) @ steps.T), probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(x), 0), int)
    return _named(point, table, dim), _named(point[:, None, :] + steps[best], table, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]  # so that no square leaves the range of numbers
    return x / np.sqrt((x * x).sum(1))[:, None]


def _met_before(unit: np.ndarray, table: int, cell: int, i: np.ndarray, j: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Whether a pair also meets in an earlier table, or in this one in a cell of a smaller name."""
    used, inv = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = inv[: len(i)], inv[len(i) :]
    out = np.zeros(len(i), bool)
    for t in range(table + 1):
        home, probed = cells(unit[used], t, probes, scale)
        at_j, at_i = home[j], home[i]
        ij = (probed[i] == at_j[:, None]).any(1) | (at_i == at_j)
        ji = (probed[j] == at_i[:, None]).any(1) | (at_i == at_j)
        out |= (ij | ji) if t < table else (ij & (at_j < cell)) | (ji & (at_i < cell))
    return out


def links(vectors: DataFrame, threshold: float = 0.95, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, tile: int = TILE) -> DataFrame:
    """(node, n, other) of vectors (id long, v array, copies long), which are distinct: n of node's links, by copies, found in a place (other null), or a link of a spanning forest (n null)."""
    spark = vectors.sparkSession
    on_workers(spark)

    def place(batches):
        for batch in batches:
            x, dims = batch.column("v").flatten().to_numpy(), np.diff(batch.column("v").offsets.to_numpy())
            first, ids = np.cumsum(dims) - dims, batch.column("id").to_numpy()
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                unit = _unit(x[first[rows][:, None] + np.arange(d)].astype(np.float64))
                for t in range(tables):
                    home, probed = cells(unit, t, probes, scale)
                    names = np.concatenate([home[:, None], probed], axis=1)
                    k = names.shape[1]
                    yield pa.RecordBatch.from_pydict({"cell": names.ravel(), "tbl": np.full(names.size, t, np.int32), "home": np.tile(np.arange(k) == 0, len(rows)), "id": np.repeat(ids[rows], k)})

    placed = written(vectors.select("id", "v").mapInArrow(place, "cell long, tbl int, home boolean, id long"), "cells")
    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("h")).where("n > 1 and h > 0")
    counts = written(counts.select(F.col("cell").alias("of"), F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "counts")
    met = placed.join(counts, F.col("cell") == F.col("of")).drop("of")
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda b: F.struct(F.least(b, own).alias("a"), F.greatest(b, own).alias("b")))
    met = met.withColumn("own", own).withColumn("pair", F.explode(others))
    met = written(met, "met")
    n = parts_for(spark, met.count(), 60_000)
    met = met.withColumn("bucket", F.pmod(F.xxhash64("cell", "pair"), F.lit(n)).cast("int")).select("bucket", "cell", "tbl", "home", "id", "own", "pair")
    # a vector goes once to each bucket that compares it, none to cells where it stands alone
    asked = met.select(F.col("bucket").alias("to"), F.col("id").alias("of")).distinct()
    sent = asked.join(vectors.select(F.col("id").alias("own_id"), "v", "copies"), F.col("of") == F.col("own_id")).select("to", "of", "v", "copies")

    def compare(table: pa.Table, sent: pa.Table) -> pa.Table:
        get = lambda c: np.array(table.column(c).combine_chunks())
        cell, home, ids, tbl, tile_of = (get(c) for c in ("cell", "home", "id", "tbl", "own"))
        pair = table.column("pair").combine_chunks()
        a, b = np.array(pair.field("a")), np.array(pair.field("b"))
        order = np.lexsort((ids, b, a, cell))
        cell, home, ids, tbl, tile_of, a, b = (x[order] for x in (cell, home, ids, tbl, tile_of, a, b))
        known = np.array(sent.column("of").combine_chunks())
        by_id = np.argsort(known)
        at = by_id[np.searchsorted(known[by_id], ids)] if len(known) else np.zeros(0, np.int64)
        copies = np.array(sent.column("copies").combine_chunks())[at]
        lists = sent.column("v").combine_chunks()
        values, edge = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        head = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(cell) else np.zeros(0, np.int64)
        nodes, where = np.unique(ids, return_inverse=True)
        total = np.zeros(len(nodes), np.int64)
        near: list[tuple[int, np.ndarray]] = []
        for lo, hi in zip(head.tolist(), np.append(head[1:], len(cell)).tolist(), strict=True):
            if hi - lo < 2 or not home[lo:hi].any():
                continue
            here = at[lo:hi]
            d = int(edge[here[0] + 1] - edge[here[0]])  # of all of them, as a cell's name has it
            unit = _unit(values[edge[here][:, None] + np.arange(d)].astype(np.float64))
            for s in range(0, hi - lo, 512):
                e = min(hi - lo, s + 512)
                close = unit[s:e] @ unit[s:].T >= threshold
                close &= home[lo + s : lo + e, None] | home[None, lo + s : hi]
                close &= np.arange(s, e)[:, None] < np.arange(s, hi - lo)[None, :]
                if a[lo] != b[lo]:  # a tile against another
                    close &= tile_of[lo + s : lo + e, None] != tile_of[None, lo + s : hi]
                i, j = np.nonzero(close)
                if not len(i):
                    continue
                i, j = i + s, j + s
                new = ~_met_before(unit, int(tbl[lo]), int(cell[lo]), i, j, tables, probes, scale)
                np.add.at(total, where[lo + i[new]], copies[lo + j[new]])
                np.add.at(total, where[lo + j[new]], copies[lo + i[new]])
                cut = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
                near += [(int(where[lo + i[p]]), where[lo + j[p:q]]) for p, q in zip(cut, np.append(cut[1:], len(i)), strict=True)]
        member, root = forest(len(nodes), iter(near))
        has = np.flatnonzero(total)
        none = [None]
        return pa.table({
            "node": pa.array(np.concatenate([nodes[has], nodes[member]]), pa.int64()), "n": pa.array(total[has].tolist() + none * len(member), pa.int64()),
            "other": pa.array(none * len(has) + nodes[root].tolist(), pa.int64()),
        })

    return met.repartition(n, "bucket").groupBy("bucket").cogroup(sent.repartition(n, "to").groupBy("to")).applyInArrow(compare, "node long, n long, other long")


def grouped(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, **options) -> DataFrame:
    """(id, n_links, component, kept) for every row: links counted over other vectors, copies included."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.when(good, v).alias("v"))
    distinct = rows.where("v is not null").groupBy("v").agg(F.min("id").alias("first"), F.count_distinct("id").alias("copies"))
    one = distinct.groupBy("first").agg(F.min(F.struct("v", "copies")).alias("x"))
    distinct = written(one.select("first", "x.v", "x.copies"), "vectors")
    found = written(links(distinct.select(F.col("first").alias("id"), "v", "copies"), threshold, **options), "found")
    sums = found.where("n is not null").groupBy("node").agg(F.sum("n").alias("n"))
    parts = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    state = distinct.join(sums, F.col("first") == F.col("node"), "left").drop("node").join(parts, F.col("first") == F.col("node"), "left")
    state = written(state.select(F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component")), "state")
    out = rows.join(state, F.col("v") == F.col("w"), "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
