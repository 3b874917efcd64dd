"""Way graphs: edges, junctions, bounded searches, shortest paths inside a gap's own part of the network."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.geo import haversine_m
from ridgeline.operators.lines import along
from ridgeline.operators.settle import forget, settled, shuffled


def node_key(lat: Column, lon: Column, places: int = 5) -> Column:
    return F.concat_ws(",", F.round(lat, places).cast("string"), F.round(lon, places).cast("string"))


def road_edges(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """(src, dst, w) both ways between neighbouring points of ways; edges without length are left out."""
    w = along(line, seq)
    p = points.select(node_key(F.col("lat"), F.col("lon")).alias("src"), F.lead(node_key(F.col("lat"), F.col("lon"))).over(w).alias("dst"), haversine_m(F.col("lat"), F.col("lon"), F.lead("lat").over(w), F.lead("lon").over(w)).alias("w"))
    one = p.where("dst is not null and w > 0")
    return one.union(one.select("dst", "src", "w"))


def junctions(points: DataFrame, line: str = "line") -> DataFrame:
    """(a, b, lat, lon): ordered pairs of different ways with a vertex in common at 5 places."""
    v = points.select(line, F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon")).distinct()
    r = v.withColumnRenamed(line, "b")
    return v.withColumnRenamed(line, "a").join(r, ["lat", "lon"]).where("a <> b").select("a", "b", "lat", "lon")


def reached(edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """(start, node, hops): breadth-first from each start (start) over edges (src, dst), each node at its fewest hops."""
    # each hop's frontier is a table of its own, so no hop is worked out again by the next
    cut = (lambda df: df.checkpoint()) if edges.sparkSession.sparkContext.getCheckpointDir() else (lambda df: df)
    edges = cut(edges)
    seen = starts.select("start", F.col("start").alias("node"), F.lit(0).alias("hops"))
    front = seen
    for k in range(1, hops + 1):
        new = front.join(edges, front["node"] == edges["src"]).select("start", F.col("dst").alias("node")).distinct().join(seen, ["start", "node"], "left_anti").withColumn("hops", F.lit(k))
        new = cut(new)
        seen, front = seen.union(new), new
    return seen


#: Edges that one task may hold of a part; larger parts are searched in rounds. Rows of a front that may be sent to every task.
PART_EDGES, FRONT_ROWS = 200_000, 100_000


def shortest_paths(edges: DataFrame, gaps: DataFrame, part: str = "part") -> DataFrame:
    """(part, src, dst, metres, hops, path): the shortest way for each gap (part, src, dst) in the edges (part, src, dst, w > 0) of
    its part of the network. Unreachable gives nulls. Equal lengths go the way of the smaller node.

    A part that a caller cuts out by a padded box is one task's Dijkstra; one of more than PART_EDGES edges is searched in
    rounds over all tasks."""
    edges = settled(edges.select(part, "src", "dst", "w"), "edges")
    large = settled(edges.groupBy(part).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART_EDGES).select(part), "large")
    if large.isEmpty():
        return _searched_by_task(edges, gaps, part)
    own = lambda df, how: df.join(large, part, how)
    return _searched_by_task(own(edges, "left_anti"), own(gaps, "left_anti"), part).unionByName(_searched_in_rounds(own(edges, "left_semi"), own(gaps, "left_semi"), part))


def _searched_in_rounds(edges: DataFrame, gaps: DataFrame, part: str) -> DataFrame:
    """shortest_paths by labels (metres, node before): a round takes every label that got shorter over its node's edges, until no
    label shorter than the farthest goal of its start is left. Ways are read from the goals back, all at once."""
    gaps = settled(gaps.select(part, "src", "dst"), "gaps")
    goals = gaps.distinct()
    node = [part, "start", "node"]
    label = F.struct("m", "before")
    start = goals.select(part, F.col("src").alias("start"), F.col("src").alias("node")).distinct()
    seen = settled(start.select(*node, F.lit(0.0).alias("m"), F.lit(None).cast("string").alias("before"), F.lit(True).alias("moved")), "labels")
    out = edges.select(F.col(part).alias("_p"), F.col("src").alias("_s"), F.col("dst").alias("_d"), "w")
    while True:
        wanted = goals.join(seen.select(part, F.col("start").alias("src"), F.col("node").alias("dst"), "m"), [part, "src", "dst"], "left")
        most = wanted.groupBy(part, F.col("src").alias("start")).agg(F.when(F.count("m") == F.count(F.lit(1)), F.max("m")).alias("most"))
        front = settled(seen.where("moved").join(most, [part, "start"]).where("most is null or m < most").select(*node, "m"), "front")
        n = front.count()
        if n == 0:
            break
        at = front.select(F.col(part).alias("_fp"), "start", "node", "m")
        at = F.broadcast(at) if n <= FRONT_ROWS else shuffled(at)  # a short front spares the edges a shuffle
        met = at.join(out, (F.col("_fp") == F.col("_p")) & (F.col("node") == F.col("_s")))
        new = met.select(F.col("_fp").alias(part), "start", F.col("_d").alias("node"), (F.col("m") + F.col("w")).alias("m"), F.col("node").alias("before"))
        both = seen.select(*node, "m", "before", F.col("m").alias("old")).unionByName(new.withColumn("old", F.lit(None).cast("double")))
        best = both.groupBy(*node).agg(F.min(label).alias("b"), F.min("old").alias("old"))
        last, seen = seen, settled(best.select(*node, "b.m", "b.before", (F.col("old").isNull() | (F.col("b.m") < F.col("old"))).alias("moved")), "labels")
        forget(last)
        forget(front)
    found = goals.join(seen.select(part, F.col("start").alias("src"), F.col("node").alias("dst"), "m"), [part, "src", "dst"])
    walk = settled(found.select(part, "src", "dst", F.col("m").alias("metres"), F.col("dst").alias("at"), F.array("dst").alias("path")), "walk")
    back = seen.select(part, F.col("start").alias("src"), F.col("node").alias("at"), "before")
    while not walk.where("at <> src").isEmpty():
        step = walk.join(back, [part, "src", "at"])
        on = F.col("at") != F.col("src")
        step = step.select(part, "src", "dst", "metres", F.when(on, F.col("before")).otherwise(F.col("at")).alias("at"), F.when(on, F.concat(F.array("before"), F.col("path"))).otherwise(F.col("path")).alias("path"))
        last, walk = walk, settled(step, "walk")
        forget(last)
    return gaps.join(walk, [part, "src", "dst"], "left").select(part, "src", "dst", "metres", (F.size("path") - 1).alias("hops"), "path")


def _searched_by_task(edges: DataFrame, gaps: DataFrame, part: str) -> DataFrame:
    """shortest_paths by Dijkstra, one part at a time in memory."""

    def search(key: tuple, g: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        near: dict[str, list] = {}
        for s, d, w in zip(e.src, e.dst, e.w, strict=True):
            near.setdefault(s, []).append((d, w))
        out = []
        for s, d in zip(g.src, g.dst, strict=True):
            best, done, heap = {s: (0.0, "")}, set(), [(0.0, s)]
            while heap:
                m, node = heapq.heappop(heap)
                if node in done:
                    continue
                done.add(node)
                if node == d:
                    break
                for to, w in near.get(node, ()):
                    new = (m + w, node)
                    if to not in done and (to not in best or new < best[to]):
                        best[to] = new
                        heapq.heappush(heap, (m + w, to))
            path = [d] if d in done else []
            while path and path[-1] != s:
                path.append(best[path[-1]][1])
            out.append((key[0], s, d, best[d][0] if path else None, len(path) - 1 if path else None, path[::-1] or None))
        return pd.DataFrame(out, columns=[part, "src", "dst", "metres", "hops", "path"])

    kind = dict(gaps.dtypes)[part]
    gaps, edges = gaps.toDF(*gaps.columns), edges.toDF(*edges.columns)  # they may come from one table
    return gaps.groupBy(part).cogroup(edges.groupBy(part)).applyInPandas(search, f"{part} {kind}, src string, dst string, metres double, hops int, path array<string>")
