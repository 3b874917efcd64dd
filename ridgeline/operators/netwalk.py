"""Walks over the network of ways from a place to the first cut of a line.

The network is edges between numbered nodes (vertices at five decimals). Each start goes out over the edges in rounds, like
rings; a round keeps what comes nearer to a node than before. Edges that cross the start's own line are found beforehand by
cells. Starts at one node with one line have one walk, which one of them goes. A walk ends where the metres to a node and on to a crossing are least, and no ring goes farther than the best end
so far or than most_m. Rounds are written as tables; no part of the network is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.geo import crossing, haversine_m
from ridgeline.operators.lines import along
from ridgeline.operators.nearest import around_in_space, cell, edges_of, space_cell
from ridgeline.operators.settle import settled, shuffled

PLACES = 5


def node_number(lat: Column, lon: Column) -> Column:
    """One number for a place at five decimals."""
    scaled = lambda x, shift: F.round((x + shift) * 10**PLACES).cast("bigint")
    return scaled(lat, 90) * (1 << 26) + scaled(lon, 180)


def network_edges(points: DataFrame, line: str = "way", seq: str = "seq") -> DataFrame:
    """(src, dst, w, lat, lon, lat2, lon2) both ways between neighbouring vertices of ways; edges without length are left out."""
    w = along(line, seq)
    p = points.select(line, seq, *(F.round(c, PLACES).alias(c) for c in ("lat", "lon")))
    p = p.select("lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2")).where("lat2 is not null and (lat <> lat2 or lon <> lon2)").distinct()
    both = p.union(p.select("lat2", "lon2", "lat", "lon")).distinct()
    return both.select(node_number(F.col("lat"), F.col("lon")).alias("src"), node_number(F.col("lat2"), F.col("lon2")).alias("dst"), haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("w"), "lat", "lon", "lat2", "lon2")


def nearest_nodes(starts: DataFrame, edges: DataFrame, within_m: float, key: str = "gap") -> DataFrame:
    """(key, node, d): for each start (key, lat, lon) the nearest node within within_m, of equals the smaller; by cells of space.

    Places meet the nodes, each once: the starts of one place have one answer."""
    nodes = edges.select(F.col("src").alias("node"), "lat", "lon").distinct().withColumn("c", space_cell(F.col("lat"), F.col("lon"), within_m))
    nodes = nodes.select("node", F.col("lat").alias("lat_n"), F.col("lon").alias("lon_n"), *(F.col(f"c.{c}").alias(f"_{c}") for c in "xyz"))
    q = around_in_space(starts.select("lat", "lon").distinct(), "lat", "lon", within_m)
    met = q.join(nodes, ["_x", "_y", "_z"]).select("lat", "lon", "node", haversine_m(F.col("lat"), F.col("lon"), F.col("lat_n"), F.col("lon_n")).alias("d")).where(F.col("d") <= within_m)
    best = met.groupBy("lat", "lon").agg(F.min(F.struct("d", "node")).alias("m"))
    return shuffled(starts.select(key, "lat", "lon")).join(best, ["lat", "lon"]).groupBy(key).agg(F.min("m").alias("m")).select(key, "m.node", "m.d")


def crossings(edges: DataFrame, lines: DataFrame, size: float, key: str = "gap") -> DataFrame:
    """(key, src, to_m, edge, lat, lon): for each line (key, seq, lat, lon) and node the nearest place on an edge from there at which
    the line is cut; both edges meet in the cells that they share."""
    def tiled(e: DataFrame) -> DataFrame:
        box = lambda c: F.sequence(cell(F.least(c, f"{c}2"), size), cell(F.greatest(c, f"{c}2"), size))
        return e.withColumn("_cy", F.explode(box("lat"))).withColumn("_cx", F.explode(box("lon")))

    own = edges_of(lines, key, "seq").select(key, F.col("seq").alias("edge"), *(F.col(c).alias(f"l_{c}") for c in ("lat", "lon", "lat2", "lon2")), "lat", "lon", "lat2", "lon2")
    own = tiled(own).drop("lat", "lon", "lat2", "lon2")
    met = shuffled(tiled(edges)).join(own, ["_cy", "_cx"])
    x = crossing((F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")), (F.col("l_lat"), F.col("l_lon")), (F.col("l_lat2"), F.col("l_lon2")))
    cut = met.select(key, "src", "edge", "lat", "lon", x.alias("x")).where("x is not null")
    to = haversine_m(F.col("lat"), F.col("lon"), F.col("x.lat"), F.col("x.lon"))
    best = cut.groupBy(key, "src").agg(F.min(F.struct(to.alias("to_m"), "edge", F.col("x.lat").alias("lat"), F.col("x.lon").alias("lon"))).alias("m"))
    return best.select(key, "src", "m.*")


def alike_starts(nodes: DataFrame, lines: DataFrame, key: str = "gap") -> DataFrame:
    """(key, node, line, first): starts (key, node) with their own line as an array of (seq, lat, lon); first is the smallest start
    of those at one node with one line, which have one walk."""
    line = lines.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("seq", "lat", "lon"))).alias("line"))
    each = shuffled(nodes.select(key, "node")).join(line, key)
    first = each.groupBy(F.col("node").alias("_node"), F.col("line").alias("_line")).agg(F.min(key).alias("first"))
    return each.join(shuffled(first), (F.col("node") == F.col("_node")) & (F.col("line") == F.col("_line"))).select(key, "node", "line", "first")


def first_cuts(points: DataFrame, starts: DataFrame, lines: DataFrame, *, most_m: float = 1200.0, reach_m: float = 120.0, size: float = 0.002, key: str = "gap", way: str = "way") -> DataFrame:
    """(key, walked_m, node, edge, lat, lon, path): for each start (key, lat, lon) the shortest walk over ways (way, seq, lat, lon) from
    its nearest node to a place where an edge cuts its line (key, seq, lat, lon); path is the nodes up to the last before the
    cut. Nodes up to most_m are gone on from. Starts without a node within reach_m, or without a cut, give no row."""
    edges = settled(network_edges(points, way), "edges")
    alike = settled(alike_starts(nearest_nodes(starts, edges, reach_m, key), lines, key), "alike")
    first = alike.where(F.col(key) == F.col("first"))
    cuts = settled(crossings(edges, first.select(key, F.inline("line")), size, key), "cuts")
    front = settled(first.select(key, "node", F.lit(0.0).alias("m"), F.array("node").alias("path")), "front")
    seen = front
    hops = edges.select(F.col("src").alias("node"), "dst", "w")
    while not front.isEmpty():
        ends = seen.join(cuts.withColumnRenamed("src", "node"), [key, "node"]).groupBy(key).agg(F.min(F.col("m") + F.col("to_m")).alias("best"))
        open_ = front.join(shuffled(ends), key, "left").where("best is null or m < best").drop("best")
        step = open_.join(shuffled(hops), "node").select(key, F.col("dst").alias("node"), (F.col("m") + F.col("w")).alias("m"), F.concat("path", F.array("dst")).alias("path")).where(F.col("m") <= most_m)
        nearer = step.groupBy(key, "node").agg(F.min(F.struct("m", "path")).alias("new"))
        known = seen.select(key, "node", F.col("m").alias("old"))
        front = settled(nearer.join(shuffled(known), [key, "node"], "left").where("old is null or new.m < old").select(key, "node", "new.m", "new.path"), "front")
        kept = seen.join(front.select(key, "node"), [key, "node"], "left_anti").unionByName(front)
        seen = settled(kept, "seen")
    ended = seen.join(cuts.withColumnRenamed("src", "node"), [key, "node"])
    best = ended.groupBy(key).agg(F.min(F.struct((F.col("m") + F.col("to_m")).alias("walked_m"), "node", "edge", "lat", "lon", "path")).alias("b"))
    return alike.select(key, "first").join(shuffled(best.select(F.col(key).alias("first"), "b.*")), "first").drop("first")
