"""Gaps of a loop: ways that bridge them, what a bridge costs, which ones are taken.

Everything is an equality join on cells or on the gap's own key; nothing is gathered but one gap's own arrays and, for the closest
vertices of every two ways, blocks of vertices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ridgeline.functions.geo import EARTH_M, edge_projection, haversine_m
from ridgeline.operators.lines import along, with_steps
from ridgeline.operators.nearest import _around, cells_of_edges, edges_of, in_cell
from ridgeline.operators.settle import spread


def nearest_edge(points: DataFrame, ways: DataFrame, within_m: float, size: float, keys: list[str]) -> DataFrame:
    """(keys, way, edge, d, t, at_lat, at_lon): for each point (keys, lat, lon) the nearest place on a way (way, seq, lat, lon)
    within within_m, which a cell's side of `size` degrees must exceed; ties to the smaller way and edge. None gives no row.

    Places meet, each once: the points of one place have one answer."""
    own = points.select(*keys, F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")).where("_qlat is not null and _qlon is not null")
    best = _met_edges(spread(own.select("_qlat", "_qlon").distinct()), ways, within_m, size).groupBy("_qlat", "_qlon").agg(F.min(F.struct(F.col("p.d").alias("d"), "way", "edge", F.col("p.t").alias("t"), F.col("p.lat").alias("at_lat"), F.col("p.lon").alias("at_lon"))).alias("b"))
    return own.join(best, ["_qlat", "_qlon"]).select(*keys, "b.way", "b.edge", "b.d", "b.t", "b.at_lat", "b.at_lon")


def _met_edges(places: DataFrame, ways: DataFrame, within_m: float, size: float) -> DataFrame:
    """places (..., _qlat, _qlon) with the edges of ways (way, edge) within within_m and p, the projection on them."""
    e = cells_of_edges(edges_of(ways, "way", "seq").withColumnRenamed("seq", "edge"), size)
    p = edge_projection((F.col("_qlat"), F.col("_qlon")), (F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")), mid_latitude=True)
    return in_cell(places, size).join(e, ["_cy", "_cx"]).select(*places.columns, "way", "edge", p.alias("p")).where(F.col("p.d") <= within_m)


def off_way_metres(bridges: DataFrame, ways: DataFrame, tol_m: float = 5.0, step_m: float = 10.0, size: float = 0.002, line: str = "line") -> DataFrame:
    """(line, length_m, off_m): of each bridge (line, seq, lat, lon) cut into steps of at most step_m, the metres whose middle
    is farther than tol_m from all ways. Edges between the same two places are cut once; a table of them has no row a step."""
    ends = ["lat", "lon", "lat2", "lon2"]
    e = edges_of(bridges, line, "seq").select(line, *ends)
    length = haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    cut = spread(e.select(*ends).distinct()).select(F.struct(*ends).alias("_e"), *ends, length.alias("m")).withColumn("parts", F.when(F.col("m") > step_m, F.ceil(F.col("m") / step_m)).otherwise(1).cast("int"))
    each = cut.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    at = (F.col("k") + 0.5) / F.col("parts")
    middle = each.select("_e", "k", "m", "parts", (F.col("lat") + at * (F.col("lat2") - F.col("lat"))).alias("_qlat"), (F.col("lon") + at * (F.col("lon2") - F.col("lon"))).alias("_qlon"))
    near = _met_edges(middle, ways, tol_m, size).groupBy("_e").agg((F.count_distinct("k") * F.max(F.col("m") / F.col("parts"))).alias("near_m"), (F.count_distinct("k") == F.max("parts")).alias("all"))
    near = near.select(*(F.col(f"_e.{c}").alias(f"_{c}") for c in ends), "near_m", "all")
    met = e.withColumn("m", length).join(near, [F.col(c) == F.col(f"_{c}") for c in ends], "left")
    off = F.when(F.col("all"), 0.0).otherwise(F.col("m") - F.coalesce("near_m", F.lit(0.0)))
    return met.groupBy(line).agg(F.sum("m").alias("length_m"), F.sum(off).alias("off_m"))


def double_ride_metres(bridges: DataFrame, others: DataFrame, within_m: float = 10.0, size: float = 0.002, line: str = "line") -> DataFrame:
    """(line, double_m): metres of each bridge's inner edges whose middle is within within_m of another line (way, seq, lat, lon);
    0 for a bridge of fewer than 4 points."""
    n = F.count(F.lit(1)).over(W.partitionBy(line))
    i = F.row_number().over(along(line, "seq"))
    e = edges_of(bridges.withColumn("_n", n).withColumn("_i", i).select(line, "seq", "lat", "lon", "_n", "_i"), line, "seq")
    place = bridges.select(line, "seq", i.alias("i"), n.alias("n"))
    e = e.join(place, [line, "seq"])
    inner = e.where((F.col("n") >= 4) & (F.col("i") > 1) & (F.col("i") < F.col("n") - 1))
    middle = inner.select(line, "seq", haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("m"), ((F.col("lat") + F.col("lat2")) / 2).alias("lat"), ((F.col("lon") + F.col("lon2")) / 2).alias("lon"))
    near = nearest_edge(middle, others, within_m, size, [line, "seq"]).select(F.col(line).alias("_l"), F.col("seq").alias("_s"))
    hit = middle.join(near, (F.col(line) == F.col("_l")) & (F.col("seq") == F.col("_s"))).groupBy(F.col(line).alias("_k")).agg(F.sum("m").alias("double_m"))
    return bridges.select(line).distinct().join(hit, F.col(line) == F.col("_k"), "left").select(line, F.coalesce("double_m", F.lit(0.0)).alias("double_m"))


def projections(requests: DataFrame, points: DataFrame, key: str = "line") -> DataFrame:
    """requests (key, which, lat, lon) with the nearest place on their own line: (key, which, edge, t, d, at_lat, at_lon)."""
    e = edges_of(points, key, "seq").select(F.col(key).alias("_l"), F.col("seq").alias("edge"), F.col("lat").alias("a"), F.col("lon").alias("b"), "lat2", "lon2")
    p = edge_projection((F.col("lat"), F.col("lon")), (F.col("a"), F.col("b")), (F.col("lat2"), F.col("lon2")), mid_latitude=True)
    met = requests.join(e, F.col(key) == F.col("_l")).select(key, "which", "edge", p.alias("p"))
    best = met.groupBy(key, "which").agg(F.min(F.struct(F.col("p.d").alias("d"), "edge", F.col("p.t").alias("t"), F.col("p.lat").alias("at_lat"), F.col("p.lon").alias("at_lon"))).alias("b"))
    return best.select(key, "which", "b.edge", "b.t", "b.d", "b.at_lat", "b.at_lon")


def slice_between(points: DataFrame, ends: DataFrame, key: str = "line") -> DataFrame:
    """(key, k, lat, lon): each line from the projection of its end 'a' to that of its end 'b' (ends: key, which, lat, lon),
    both projected places included, in the direction from a to b."""
    p = projections(ends, points, key)
    one = lambda x: F.max(F.when(F.col("which") == x, F.struct((F.col("edge") + F.col("t")).alias("s"), F.col("at_lat").alias("lat"), F.col("at_lon").alias("lon"))))
    both = p.groupBy(F.col(key).alias("_l")).agg(one("a").alias("a"), one("b").alias("b")).where("a is not null and b is not null")
    back = F.col("b.s") < F.col("a.s")
    met = points.join(both, F.col(key) == F.col("_l"))
    inner = met.where((F.col("seq") > F.least("a.s", "b.s")) & (F.col("seq") < F.greatest("a.s", "b.s"))).select(key, F.col("seq").cast("double").alias("s"), "lat", "lon", back.alias("back"))
    tips = both.select(F.col("_l").alias(key), F.explode(F.array("a", "b")).alias("x"), back.alias("back")).select(key, "x.s", "x.lat", "x.lon", "back")
    whole = inner.unionByName(tips.select(key, "s", "lat", "lon", "back"))
    order = F.when(F.col("back"), -F.col("s")).otherwise(F.col("s"))
    return whole.withColumn("k", F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).select(key, "k", "lat", "lon")


def clip_by_vertices(points: DataFrame, ends: DataFrame, key: str = "line") -> DataFrame:
    """(key, k, seq): each line's vertices from the one nearest its end 'a' to the one nearest its end 'b', in that direction."""
    v = points.select(F.col(key).alias("_l"), "seq", F.col("lat").alias("_a"), F.col("lon").alias("_b"))
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("_a"), F.col("_b"))
    near = ends.join(v, F.col(key) == F.col("_l")).groupBy(key, "which").agg(F.min(F.struct(d.alias("d"), "seq")).alias("m"))
    both = near.groupBy(F.col(key).alias("_l")).agg(*(F.max(F.when(F.col("which") == x, F.col("m.seq"))).alias(x) for x in ("a", "b")))
    met = points.join(both, F.col(key) == F.col("_l")).where(F.col("seq").between(F.least("a", "b"), F.greatest("a", "b")))
    order = F.when(F.col("b") < F.col("a"), -F.col("seq")).otherwise(F.col("seq"))
    return met.withColumn("k", F.row_number().over(W.partitionBy(key).orderBy(order)) - 1).select(key, "k", "seq")


def best_matching_way(points: DataFrame, ways: DataFrame, penalty: DataFrame, key: str = "gap") -> DataFrame:
    """(key, way, mean_m, score): the way whose vertices lie nearest to a gap's points (key, i, lat, lon) on the mean, plus its
    type's penalty (way, penalty_m). ways (key, way, lat, lon) are those that a caller cut out for each gap; ties to the smaller way."""
    v = ways.select(F.col(key).alias("_k"), "way", F.col("lat").alias("_a"), F.col("lon").alias("_b"))
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("_a"), F.col("_b"))
    per_point = points.join(v, F.col(key) == F.col("_k")).groupBy(key, "i", "way").agg(F.min(d).alias("d"))
    mean = per_point.groupBy(key, "way").agg(F.avg("d").alias("mean_m")).join(penalty.select(F.col("way").alias("_w"), "penalty_m"), F.col("way") == F.col("_w"))
    score = F.col("mean_m") + F.col("penalty_m")
    return mean.groupBy(key).agg(F.min(F.struct(score.alias("score"), "way", "mean_m")).alias("b")).select(key, "b.way", "b.mean_m", "b.score")


def reliable_points(points: DataFrame, ways: DataFrame, within_m: float = 25.0, first: int = 6, size: float = 0.002, line: str = "line") -> DataFrame:
    """(line, seq): the first points of each line that lie near a way, `first` at most (a feature); the line's first point if none does."""
    near = nearest_edge(points, ways, within_m, size, [line, "seq"]).select(line, "seq")
    ranked = near.withColumn("_r", F.row_number().over(along(line, "seq"))).where(F.col("_r") <= first).select(line, "seq")
    lone = points.groupBy(line).agg(F.min("seq").alias("seq")).join(near.select(line).distinct(), line, "left_anti")
    return ranked.unionByName(lone.select(line, "seq"))


def walk_to_line(way: DataFrame, starts: DataFrame, met: DataFrame, tol_m: float, max_walk_m: float, size: float, key: str = "line") -> DataFrame:
    """(key, direction, seq, walked_m): from each line's start edge (key, edge, t) both ways along it to the first vertex within
    tol_m of a line of met (way, seq, lat, lon), within max_walk_m."""
    near = nearest_edge(way, met, tol_m, size, [key, "seq"]).select(F.col(key).alias("_l"), F.col("seq").alias("_s"))
    w = along(key, "seq")
    at = with_steps(way, key, "seq").withColumn("m", F.sum(F.coalesce("step_m", F.lit(0.0))).over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("next_m", F.lead("m").over(w))
    begin = starts.select(F.col(key).alias("_k"), F.col("edge"), F.col("t"))
    start_m = at.join(begin, (F.col(key) == F.col("_k")) & (F.col("seq") == F.col("edge"))).select(F.col(key).alias("_k2"), "edge", (F.col("m") + F.col("t") * (F.coalesce("next_m", "m") - F.col("m"))).alias("m0"))
    seen = at.join(near, (F.col(key) == F.col("_l")) & (F.col("seq") == F.col("_s"))).join(start_m, F.col(key) == F.col("_k2"))
    forward = F.col("seq") > F.col("edge")
    walked = F.abs(F.col("m") - F.col("m0"))
    rows = seen.select(key, F.when(forward, "forward").otherwise("backward").alias("direction"), "seq", walked.alias("walked_m")).where(F.col("walked_m") <= max_walk_m)
    return rows.groupBy(key, "direction").agg(F.min(F.struct("walked_m", "seq")).alias("b")).select(key, "direction", "b.seq", "b.walked_m")


def closest_vertices(left: DataFrame, right: DataFrame, within_m: float, size: tuple[float, float], key: str = "a", other: str = "b") -> DataFrame:
    """(key, other, sa, sb, d): of every two ways with vertices within within_m the closest pair, by cells,
    for ways of which few are near each other: pairs of vertices are shuffled."""
    from ridgeline.operators.nearest import cell

    q = _around(left.select(key, F.col("seq").alias("sa"), F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")), "_qlat", "_qlon", size)
    p = right.select(other, F.col("seq").alias("sb"), "lat", "lon", cell(F.col("lat"), size[0]).alias("_cy"), cell(F.col("lon"), size[1]).alias("_cx"))
    d = haversine_m(F.col("_qlat"), F.col("_qlon"), F.col("lat"), F.col("lon"))
    met = q.join(p, ["_cy", "_cx"]).where(F.col(key) != F.col(other)).select(key, other, "sa", "sb", d.alias("d")).where(F.col("d") <= within_m)
    return met.groupBy(key, other).agg(F.min(F.struct("d", "sa", "sb")).alias("m")).select(key, other, "m.sa", "m.sb", "m.d")


def closest_of_all(left: DataFrame, right: DataFrame, within_m: float, size: tuple[float, float], key: str = "a", other: str = "b", block: int = 1 << 14, ways: int = 1 << 10) -> DataFrame:
    """(key, other, sa, sb, d): closest_vertices where most ways may be near each other, so that the result may hold every two.

    Ways are dealt to blocks of some `block` vertices and `ways` ways at most, each block of one side meets each of the
    other in one row, and what is found there is final: no pair is shuffled or sorted, and a task holds the pairs of two blocks."""

    def blocks(df: DataFrame, line: str, name: str) -> DataFrame:
        known = df.where("lat is not null and lon is not null")
        size = known.agg(F.count(F.lit(1)).alias("points"), F.count_distinct(line).alias("ways")).first()
        n = max(1, -(-size.points // block), -(-size.ways // ways))
        each = known.select(F.pmod(F.xxhash64(line), F.lit(n)).alias("_t"), F.struct(F.col(line).alias("line"), F.col("seq").alias("seq"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).alias("p"))
        # few blocks a part, so few meet in a batch of rows
        return each.groupBy("_t").agg(F.collect_list("p").alias(name)).select(name, "_t").repartition(-(-n // 4), "_t").select(name)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = (batch.column(c).slice(i, 1).flatten() for c in ("_p", "_q"))
                yield from _closest(*sides, within_m, size, schema)

    met_rows = blocks(left, key, "_p").crossJoin(blocks(right, other, "_q").hint("shuffle_replicate_nl"))
    kinds = [(key, left.schema[key].dataType), (other, right.schema[other].dataType), ("sa", left.schema["seq"].dataType), ("sb", right.schema["seq"].dataType), ("d", DoubleType())]
    out = StructType([StructField(n, t) for n, t in kinds])
    schema = to_arrow_schema(out)
    return met_rows.mapInArrow(met, out)


def _closest(p: pa.StructArray, q: pa.StructArray, within_m: float, size: tuple[float, float], schema: pa.Schema, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The closest vertices of each two ways of two blocks (line, seq, lat, lon). Distinct places meet; `most` pairs of vertices at a time."""
    side = []
    for x in (p, q):
        line = x.field("line").dictionary_encode()
        seq, rank = np.unique(x.field("seq").to_numpy(zero_copy_only=False), return_inverse=True)
        place, of = np.unique(np.column_stack([x.field(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon")]), axis=0, return_inverse=True)
        by = np.argsort(of := of.ravel(), kind="stable")
        side.append((line.dictionary, line.indices.to_numpy()[by], seq, rank[by], place, np.searchsorted(of[by], np.arange(len(place) + 1))))
    (names_a, line_a, seq_a, rank_a, a, off_a), (names_b, line_b, seq_b, rank_b, b, off_b) = side
    i, j = _near_cells(a, b, size)
    h = lambda c: np.sin(np.radians(b[j, c] - a[i, c]) / 2) ** 2
    d = 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(h(0) + np.cos(np.radians(a[i, 0])) * np.cos(np.radians(b[j, 0])) * h(1), 1)))
    i, j, d = i[d <= within_m], j[d <= within_m], d[d <= within_m]
    n_a, n_b = off_a[i + 1] - off_a[i], off_b[j + 1] - off_b[j]
    part = (np.cumsum(n_a * n_b) - n_a * n_b) // most
    cuts = np.searchsorted(part, np.unique(part))

    def pairs() -> Iterator[tuple[np.ndarray, ...]]:
        """Vertices of both sides with their cell in the table of ways by ways, and their distance."""
        for lo, hi in zip(cuts, np.append(cuts[1:], len(i)), strict=True):
            n = n_a[lo:hi] * n_b[lo:hi]
            k = np.repeat(np.arange(lo, hi), n)
            nth = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
            x, y = off_a[i[k]] + nth // n_b[k], off_b[j[k]] + nth % n_b[k]
            yield x, y, line_a[x].astype(np.int64) * len(names_b) + line_b[y], d[k]

    best = np.full(len(names_a) * len(names_b), np.inf)
    for _, _, at, far in pairs():
        np.minimum.at(best, at, far)
    first = np.full(len(best), np.iinfo(np.int64).max)
    for x, y, at, far in pairs():
        hit = far == best[at]
        np.minimum.at(first, at[hit], rank_a[x[hit]] * len(seq_b) + rank_b[y[hit]])
    found = np.flatnonzero(np.isfinite(best))
    m, n = names_a.take(pa.array(found // len(names_b))), names_b.take(pa.array(found % len(names_b)))
    columns = [m, n, pa.array(seq_a[first[found] // len(seq_b)]), pa.array(seq_b[first[found] % len(seq_b)]), pa.array(best[found])]
    table = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    yield from table.filter(pc.not_equal(m, n)).to_batches(1 << 16)


def _near_cells(a: np.ndarray, b: np.ndarray, size: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of places (lat, lon) in the same cell or in two that touch."""
    ca, cb = (np.floor(x / np.array(size)).astype(np.int64) for x in (a, b))
    code = lambda y, x: (y << 32) + x
    of_b = code(cb[:, 0], cb[:, 1])
    order = np.argsort(of_b, kind="stable")
    of_b = of_b[order]
    rows, found = [], []
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            want = code(ca[:, 0] + dy, ca[:, 1] + dx)
            lo, hi = np.searchsorted(of_b, want), np.searchsorted(of_b, want, "right")
            n = hi - lo
            rows.append(np.repeat(np.arange(len(a)), n))
            found.append(order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)])
    return np.concatenate(rows), np.concatenate(found)


def reusable_connector(connectors: DataFrame, gaps: DataFrame, within_m: float = 60.0) -> DataFrame:
    """(gap, segment, ia, ib, score): of the connectors (tour, segment, seq, lat, lon) of a gap's tour (gap, tour, a_lat, a_lon,
    b_lat, b_lon) the one with different vertices near both ends and the smallest sum of distances."""
    met = gaps.withColumnRenamed("tour", "_t").join(connectors, F.col("_t") == F.col("tour"))
    da, db = (haversine_m(F.col(f"{x}_lat"), F.col(f"{x}_lon"), F.col("lat"), F.col("lon")) for x in ("a", "b"))
    each = met.select("gap", "segment", "seq", da.alias("da"), db.alias("db"))
    best = each.groupBy("gap", "segment").agg(F.min(F.struct(F.col("da").alias("d"), "seq")).alias("a"), F.min(F.struct(F.col("db").alias("d"), "seq")).alias("b"))
    ok = best.where((F.col("a.d") <= within_m) & (F.col("b.d") <= within_m) & (F.col("a.seq") != F.col("b.seq")))
    score = F.col("a.d") + F.col("b.d")
    return ok.groupBy("gap").agg(F.min(F.struct(score.alias("score"), "segment", F.col("a.seq").alias("ia"), F.col("b.seq").alias("ib"))).alias("m")).select("gap", "m.segment", "m.ia", "m.ib", "m.score")


def stretch_between(recording: DataFrame, gaps: DataFrame, within_m: float = 60.0, slack_m: float = 250.0, floor_m: float = 5.0, times: float = 3.0, key: str = "line") -> DataFrame:
    """(key, ia, ib, ridden_m): the shortest stretch of a recording (key, seq, lat, lon, m) from near a gap's start to near its
    end (key, a_lat, a_lon, b_lat, b_lon, gap_m) that is as long as a bridge may be. Starts are moved ahead by the least length;
    for each place near the end the start with most metres before it then decides, of equal ones the first, so no pairs are made."""
    met = recording.join(gaps.withColumnRenamed(key, "_g"), F.col(key) == F.col("_g"))
    near = lambda x: haversine_m(F.col(f"{x}_lat"), F.col(f"{x}_lon"), F.col("lat"), F.col("lon")) <= within_m
    marked = met.select(key, "seq", "m", "gap_m", near("a").alias("at_a"), near("b").alias("at_b"))
    least = F.greatest(F.col("gap_m") - floor_m, F.lit(0.0))
    start = F.struct(F.col("m").alias("m0"), (-F.col("seq")).alias("back"))
    moved = marked.where("at_a").select(key, (F.col("m") + least).alias("at"), F.lit(0).alias("kind"), "seq", "m", "gap_m", start.alias("s"))
    ends = marked.where("at_b").select(key, F.col("m").alias("at"), F.lit(1).alias("kind"), "seq", "m", "gap_m", F.when(F.lit(False), start).alias("s"))
    # an end stands before the start of its own place, which is no start for it
    last = F.max("s").over(along(key, "at", "seq", F.col("kind").desc()).rowsBetween(W.unboundedPreceding, -1))
    got = moved.unionByName(ends).withColumn("s", last).where("kind = 1 and s is not null").withColumn("ridden_m", F.col("m") - F.col("s.m0"))
    most = F.greatest(times * F.col("gap_m"), F.col("gap_m") + slack_m)
    fits = got.withColumn("ia", -F.col("s.back")).where((F.col("ia") < F.col("seq")) & (F.col("ridden_m") <= most))
    return fits.groupBy(key).agg(F.min(F.struct("ridden_m", "ia", F.col("seq").alias("ib"))).alias("b")).select(key, "b.ia", "b.ib", "b.ridden_m")


def accepted(candidates: DataFrame, budgets: DataFrame, beeline_most_m: float = 1500.0) -> DataFrame:
    """(gap, no, mode): for each gap (gap, beeline_m, budget_m) the first ranked candidate (gap, no, rank, off, len, trim, relaxed)
    that is strict, else the first relaxed one; a trim beyond the gap's budget, or a gap beyond beeline_most_m, is left out."""
    met = candidates.join(budgets.withColumnRenamed("gap", "_g"), F.col("gap") == F.col("_g")).where((F.col("beeline_m") <= beeline_most_m) & (F.col("trim") <= F.col("budget_m")))
    best = met.groupBy("gap").agg(F.min(F.struct(F.col("relaxed").alias("r"), "rank", "no")).alias("b"))
    return best.select("gap", "b.no", F.when(F.col("b.r"), "relaxed").otherwise("strict").alias("mode"))


def applied(segments: DataFrame, bridges: DataFrame, line: str = "line") -> DataFrame:
    """segments (line, pos, kind) with bridges (line, pos, metres) put in after their position: a connector that follows grows,
    else one that stands before, else a new connector is put in. Returns (line, at, kind, grown_m) in order."""
    w = along(line, "pos")
    both = segments.withColumn("next_kind", F.lead("kind").over(w)).join(bridges.select(F.col(line).alias("_l"), F.col("pos").alias("_p"), "metres"), (F.col(line) == F.col("_l")) & (F.col("pos") == F.col("_p")), "left")
    to_next = F.col("metres").isNotNull() & (F.col("next_kind") == "connector")
    to_own = F.col("metres").isNotNull() & ~F.coalesce(to_next, F.lit(False)) & (F.col("kind") == "connector")
    new = F.col("metres").isNotNull() & ~F.coalesce(to_next, F.lit(False)) & ~to_own
    marked = both.select(line, "pos", "kind", F.when(to_next, F.col("metres")).otherwise(0.0).alias("give"), F.when(to_own, F.col("metres")).otherwise(0.0).alias("own"), F.when(new, F.col("metres")).alias("put"))
    grown = F.col("own") + F.coalesce(F.lag("give").over(w), F.lit(0.0))
    kept = marked.select(line, F.col("pos").cast("double").alias("o"), "kind", grown.alias("grown_m"))
    added = marked.where("put is not null").select(line, (F.col("pos") + 0.5).alias("o"), F.lit("connector").alias("kind"), F.col("put").alias("grown_m"))
    return kept.unionByName(added).withColumn("at", F.row_number().over(along(line, "o")) - 1).select(line, "at", "kind", "grown_m")


def same_type_groups(ways: DataFrame, tol_places: int = 5) -> DataFrame:
    """(way, group): ways (way, kind, name, a_lat, a_lon, b_lat, b_lon) of one kind and name whose ends touch are one group,
    named by its smallest way. Labels spread along shared ends and to the way a way is labelled with, and each way takes over
    the label of the one it is labelled with, so a chain of n ways settles in some log n rounds. Labels only fall, so the rounds
    end; each is a table."""
    from ridgeline.operators.graph import node_key
    from ridgeline.operators.settle import forget, settled

    ends = ways.select("way", F.explode(F.array(*(F.concat_ws("|", F.coalesce("kind", F.lit("")), F.coalesce("name", F.lit("")), node_key(F.col(f"{x}_lat"), F.col(f"{x}_lon"), tol_places)) for x in ("a", "b")))).alias("end")).distinct()
    ends = settled(ends, "ends")
    label = settled(ways.select("way", F.col("way").alias("group")), "labels")
    while True:
        here = ends.join(label, "way").groupBy("end").agg(F.min("group").alias("g"))
        near = ends.join(here, "end").groupBy("way").agg(F.min("g").alias("g")).join(label, "way")
        told = near.select(F.explode(F.array("way", "group")).alias("way"), "g").groupBy("way").agg(F.min("g").alias("group"))
        told = settled(told, "told")
        ahead = told.select(F.col("way").alias("_w"), F.col("group").alias("_g"))
        new = settled(told.join(ahead, F.col("group") == F.col("_w")).select("way", F.col("_g").alias("group")), "labels")
        forget(told)
        done = new.join(label.withColumnRenamed("group", "old"), "way").where("group <> old").isEmpty()
        forget(label)
        if done:
            return new
        label = new


def closing_report(gaps: DataFrame) -> DataFrame:
    """(method, n, mean_factor, suspicious) over closed gaps (method, beeline_m, route_m): the route's factor, over 3 is suspicious."""
    factor = F.col("route_m") / F.nullif(F.col("beeline_m"), F.lit(0.0))
    return gaps.groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.avg(factor).alias("mean_factor"), F.count_if(factor > 3).alias("suspicious"))


def ways_for_gaps(ways: DataFrame, gaps: DataFrame, pad_m: float, size: float = 0.02, vertices: bool = False) -> DataFrame:
    """(gap, way): of ways fetched once (way, seq, lat, lon) those for each gap (gap, a_lat, a_lon, b_lat, b_lon): whose box
    overlaps the gap's padded box, or with `vertices` that have a vertex in it."""
    from ridgeline.functions.geo import padded_box
    from ridgeline.operators.nearest import cell
    from ridgeline.operators.regions import near_route

    box = gaps.select(F.col("gap").alias("route"), padded_box(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"), pad_m).alias("b")).select("route", "b.*")
    if not vertices:
        of_way = ways.groupBy(F.col("way").alias("line")).agg(*(f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")))
        return near_route(box, of_way, 0.0, size).select(F.col("route").alias("gap"), F.col("line").alias("way"))
    tiled = box.withColumn("_cy", F.explode(F.sequence(cell(F.col("min_lat"), size), cell(F.col("max_lat"), size)))).withColumn("_cx", F.explode(F.sequence(cell(F.col("min_lon"), size), cell(F.col("max_lon"), size))))
    v = ways.select("way", "lat", "lon", cell(F.col("lat"), size).alias("_cy"), cell(F.col("lon"), size).alias("_cx"))
    met = tiled.join(v, ["_cy", "_cx"]).where("lat between min_lat and max_lat and lon between min_lon and max_lon")
    return met.select(F.col("route").alias("gap"), "way").distinct()


def bridge_along_way(gaps: DataFrame, points: DataFrame, ways: DataFrame, penalty: DataFrame, most_m: float = 15.0) -> DataFrame:
    """(gap, k, lat, lon): the stretch between a gap's ends of the way that its points follow within most_m on the mean.

    gaps (gap, a_lat, a_lon, b_lat, b_lon); points (gap, i, lat, lon) of the side to match; ways (gap, way, seq, lat, lon) cut
    out for each gap; penalty (way, penalty_m)."""
    best = best_matching_way(points, ways, penalty, "gap").where(F.col("mean_m") <= most_m).select(F.col("gap").alias("_g"), F.col("way").alias("_w"))
    own = ways.join(best, (F.col("gap") == F.col("_g")) & (F.col("way") == F.col("_w"))).select(F.col("gap").alias("line"), "seq", "lat", "lon")
    end = lambda x: F.struct(F.lit(x).alias("which"), F.col(f"{x}_lat").alias("lat"), F.col(f"{x}_lon").alias("lon"))
    ends = gaps.select(F.col("gap").alias("line"), F.explode(F.array(end("a"), end("b"))).alias("e")).select("line", "e.*")
    return slice_between(own, ends).withColumnRenamed("line", "gap")


def recorded_connectors(recording: DataFrame, gaps: DataFrame, key: str = "line", **options) -> DataFrame:
    """(key, ia, ib, ridden_m, note): the recording's stretch for each gap, or the note that the gap stays open."""
    found = stretch_between(recording, gaps, key=key, **options)
    return gaps.select(key).join(found, key, "left").withColumn("note", F.when(F.col("ia").isNull(), "open gap").otherwise("recorded"))


def closed_loops(segments: DataFrame, candidates: DataFrame, threshold_m: float, beeline_most_m: float = 1500.0) -> DataFrame:
    """(line, at, kind, grown_m): the loops' joints over threshold_m bridged by their accepted candidates.

    segments (line, seq, kind, start_lat, start_lon, end_lat, end_lon); candidates (line, seq, no, rank, relaxed, trim, budget_m,
    route_m) for the joint after seq."""
    from ridgeline.operators.runs import joint_gaps

    joints = joint_gaps(segments, threshold_m).select(F.struct("line", "seq").alias("gap"), F.col("gap_m").alias("beeline_m"))
    c = candidates.withColumn("gap", F.struct("line", "seq"))
    budgets = joints.join(c.groupBy("gap").agg(F.max("budget_m").alias("budget_m")), "gap")
    taken = accepted(c.drop("budget_m"), budgets, beeline_most_m).select(F.col("gap").alias("_g"), F.col("no").alias("_n"))
    bridges = c.join(taken, (F.col("gap") == F.col("_g")) & (F.col("no") == F.col("_n"))).select("line", F.col("seq").alias("pos"), F.col("route_m").alias("metres"))
    return applied(segments.select("line", F.col("seq").alias("pos"), "kind"), bridges)
