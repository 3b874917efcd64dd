"""Nearest-neighbour joins by grid cells.

A range predicate would plan as a nested loop. Here edges go to the cells they touch and those around, points look
into their own, so a point meets an edge once, and the join is an equality of cells. The radius must not exceed a
cell's side.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.geo import EARTH_M, edge_projection, haversine_m
from ridgeline.operators.settle import settled, shuffled, spread


def cell(x: Column, size: float) -> Column:
    """floor, never truncation: longitudes west of zero are real."""
    return F.floor(x / size).cast("long")


def _around(df: DataFrame, lat: str, lon: str, size: tuple[float, float]) -> DataFrame:
    ring = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    return df.withColumn("_o", F.explode(ring)).withColumn("_cy", cell(F.col(lat), size[0]) + F.col("_o.i")).withColumn("_cx", cell(F.col(lon), size[1]) + F.col("_o.j")).drop("_o")


#: Places that a list may have to be sent to every task as one array; longer lists go by cells.
FEW = 1000


def place_list(places: DataFrame) -> DataFrame | None:
    """All rows of a short list as one row with an array `_places`, null where the list has more than FEW rows."""
    if places.limit(FEW + 1).count() > FEW:
        return None
    return F.broadcast(places.agg(F.collect_list(F.struct(*places.columns)).alias("_places")))


def nearest_anchor(lines: DataFrame, anchors: DataFrame, max_km: float | None = None, key: str = "line") -> DataFrame:
    """Each line (key, lat, lon) with the nearest of the anchors (anchor, lat, lon) and km; ties to the smaller anchor. Beyond
    max_km the anchor is null, as it is where there is none.

    A short list is an array that each row looks through, without a shuffle; a longer one goes by cells of space, in sizes
    that grow, and lines that are far from all anchors go down a tree of cells."""
    a = anchors.select("anchor", F.col("lat").alias("_alat"), F.col("lon").alias("_alon"))
    listed = place_list(a)
    if listed is not None:
        d = F.transform("_places", lambda p: F.struct((haversine_m(F.col("lat"), F.col("lon"), p["_alat"], p["_alon"]) / 1000).alias("km"), p["anchor"].alias("anchor")))
        best = lines.crossJoin(listed).withColumn("_b", F.array_min(d)).drop("_places")
    else:
        near = _cheapest_by_rings(lines, a.select("anchor", F.col("_alat").alias("la"), F.col("_alon").alias("lo"), F.lit(0.0).alias("extra")), 1, 1000.0)
        best = lines.join(near.select(F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon"), F.struct(F.col("cost").alias("km"), "anchor").alias("_b")), (F.col("lat") == F.col("_qlat")) & (F.col("lon") == F.col("_qlon")), "left").drop("_qlat", "_qlon")
    best = best.withColumn("km", F.col("_b.km")).withColumn("anchor", F.col("_b.anchor")).drop("_b")
    return best if max_km is None else best.withColumn("anchor", F.when(F.col("km") <= max_km, F.col("anchor")))


def cheapest_places(lines: DataFrame, places: DataFrame, k: int, key: str = "line") -> DataFrame:
    """(key, rank, anchor, cost): for each line (key, lat, lon) the k places (anchor, la, lo, extra) with the smallest metres plus extra."""
    listed = place_list(places)
    if listed is None:
        return lines.select(key, "lat", "lon").join(_cheapest_by_rings(lines, places, k), ["lat", "lon"]).select(key, "rank", "anchor", "cost")
    cost = F.transform("_places", lambda p: F.struct((haversine_m(F.col("lat"), F.col("lon"), p["la"], p["lo"]) + p["extra"]).alias("cost"), p["anchor"].alias("anchor")))
    best = lines.crossJoin(listed).select(key, F.posexplode(F.slice(F.array_sort(cost), 1, k)).alias("rank", "b"))
    return best.select(key, (F.col("rank") + 1).alias("rank"), "b.anchor", "b.cost")


def space_cell(lat: Column, lon: Column, side_m: float) -> Column:
    """struct(x, y, z): the cube of side_m metres that a place on the globe lies in; no latitude or longitude is special."""
    return F.struct(*(F.floor(v / side_m).alias(c) for c, v in zip("xyz", _xyz(lat, lon), strict=True)))


def around_in_space(df: DataFrame, lat: str, lon: str, side_m: float) -> DataFrame:
    """df with _x, _y, _z: a row for the cube of a place and each cube around it, so that places within side_m meet."""
    ring = F.array(*(F.struct(*(F.lit(v).alias(c) for v, c in zip(o, "xyz", strict=True))) for o in product((-1, 0, 1), repeat=3)))
    each = df.withColumn("_c", space_cell(F.col(lat), F.col(lon), side_m)).withColumn("_o", F.explode(ring))
    return shuffled(each.select(*df.columns, *((F.col(f"_c.{c}") + F.col(f"_o.{c}")).alias(f"_{c}") for c in "xyz")))


def _xyz(lat: Column, lon: Column, name: str = "") -> list[Column]:
    """Metres from the centre of the globe, as columns x, y and z with `name` before."""
    y, x = F.radians(lat), F.radians(lon)
    at = (F.cos(y) * F.cos(x) * EARTH_M, F.cos(y) * F.sin(x) * EARTH_M, F.sin(y) * EARTH_M)
    return [v.alias(f"{name}{c}") for c, v in zip("xyz", at, strict=True)]


#: Metres of a cube's side: of the rings around a line, then of the tree that far lines go down, each ten of the next.
RINGS, TREE = (2_000.0, 8_000.0, 32_000.0, 128_000.0), (1_600_000.0, 160_000.0, 16_000.0)


def _cheapest_by_rings(lines: DataFrame, places: DataFrame, k: int, unit: float = 1.0) -> DataFrame:
    """(lat, lon, rank, anchor, cost) for each distinct place of lines, cost in `unit` metres: as cheapest_places, for lists of any length.

    A line looks at the cubes around its own where that holds k places at least, small cubes first, so it meets few. It is
    settled where its k-th costs no more than a cube's side and the smallest extra: places that it did not meet are farther
    than the side. What no ring settles goes down the tree."""
    own = W.partitionBy("la", "lo").orderBy("extra", "anchor")  # of the places at one spot k can be among the cheapest
    p = places.select("anchor", "la", "lo", "extra").withColumn("_r", F.row_number().over(own)).where(F.col("_r") <= k).drop("_r")
    p = settled(p.select("*", *_xyz(F.col("la"), F.col("lo"), "_p")), "places")
    least = p.agg(F.min("extra")).first()[0] or 0.0
    spots = lines.select("lat", "lon").where("lat is not null and lon is not null").distinct()
    open_, found = settled(spots.select("*", *_xyz(F.col("lat"), F.col("lon"), "_q")), "spots"), None
    m = haversine_m(F.col("lat"), F.col("lon"), F.col("la"), F.col("lo"))
    each, whole = W.partitionBy("lat", "lon").orderBy("cost", "anchor"), W.partitionBy("lat", "lon")
    for side in RINGS:
        cube = lambda c, side=side: [F.floor(F.col(f"{c}{x}") / side).alias(f"_{x}") for x in "xyz"]
        dealt = p.select("anchor", "la", "lo", "extra", *cube("_p"))
        full = dealt.groupBy("_x", "_y", "_z").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).drop("_n")
        look = open_.select("lat", "lon", *cube("_q")).join(shuffled(full), ["_x", "_y", "_z"]).select("lat", "lon")
        met = around_in_space(look, "lat", "lon", side).join(dealt, ["_x", "_y", "_z"]).where(m <= side)
        met = met.select("lat", "lon", "anchor", ((m + F.col("extra")) / unit).alias("cost")).withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= k)
        sure = met.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_most", F.max("cost").over(whole)).where((F.col("_n") == k) & (F.col("_most") * unit <= side + least - 0.001))
        sure = settled(sure.select("lat", "lon", "rank", "anchor", "cost"), "near")
        found = sure if found is None else found.union(sure)
        open_ = settled(open_.join(sure.select("lat", "lon"), ["lat", "lon"], "left_anti"), "open")
        if open_.isEmpty():
            return shuffled(found)
    far = _down_the_cells(open_.select(F.struct("lat", "lon").alias("_spot"), "lat", "lon"), p, k, "_spot")
    return shuffled(found.union(far.select("_spot.lat", "_spot.lon", "rank", "anchor", F.col("cost") / unit)))


def _down_the_cells(lines: DataFrame, places: DataFrame, k: int, key: str) -> DataFrame:
    """(key, rank, anchor, cost) as cheapest_places, for lists of any length.

    Places lie in a tree of cubes. A cube costs a line no less than the metres to its center, less half its diagonal, plus the
    smallest extra in it, and one place of each cube is known. So a line leaves cubes that cost more than the k-th of the known
    places, and goes on with the cubes in the others. The first cubes are a list of under a thousand at any number of places.
    Lines keep their candidates as rows of their own; what a cube holds meets only the lines that may want it."""
    name = lambda n: F.struct(*(F.floor(F.col(c) / (TREE[n])).alias(c) for c in "xyz"))
    p = places.select("anchor", "la", "lo", "extra", *_xyz(F.col("la"), F.col("lo")))
    p = settled(p.select("anchor", "la", "lo", "extra", *(name(n).alias(f"c{n}") for n in range(len(TREE)))), "tree")

    def cubes(n: int) -> DataFrame:
        best = F.min(F.struct("extra", "anchor", "la", "lo"))
        up = [F.col(f"c{n - 1}").alias("parent")] if n else []
        return p.groupBy(*([f"c{n - 1}"] if n else []), f"c{n}").agg(best.alias("b")).select(*up, F.col(f"c{n}").alias("cube"), "b")

    def bounds(cube: Column, b: Column, n: int, at: dict[str, Column], lat: Column, lon: Column) -> tuple[Column, Column]:
        side = TREE[n]
        gap = F.sqrt(sum(((cube[c] + 0.5) * side - at[c]) * ((cube[c] + 0.5) * side - at[c]) for c in "xyz")) - side * 0.8661
        return F.greatest(gap, F.lit(0.0)) + b["extra"] - 0.001, haversine_m(lat, lon, b["la"], b["lo"]) + b["extra"]

    q = lines.select(key, "lat", "lon", *_xyz(F.col("lat"), F.col("lon"), "_"))
    at = {c: F.col(f"_{c}") for c in "xyz"}

    def told(x: Column) -> Column:
        low, high = bounds(x["cube"], x["b"], 0, at, F.col("lat"), F.col("lon"))
        return F.struct(x["cube"].alias("cube"), low.alias("low"), high.alias("high"))

    first = F.broadcast(cubes(0).agg(F.collect_list(F.struct("cube", "b")).alias("_all")))
    seen = q.crossJoin(first).withColumn("_all", F.transform("_all", told)).withColumn("_most", F.get(F.array_sort(F.transform("_all", lambda x: x["high"])), F.lit(k - 1)))
    front = seen.withColumn("_f", F.explode(F.filter("_all", lambda x: F.col("_most").isNull() | (x["low"] <= F.col("_most"))))).select(key, "lat", "lon", *at.values(), F.col("_f.cube").alias("_cube"))
    for n in range(1, len(TREE)):
        low, high = bounds(F.col("cube"), F.col("b"), n, at, F.col("lat"), F.col("lon"))
        step = front.join(cubes(n), F.col("_cube") == F.col("parent")).select(key, "lat", "lon", *at.values(), "cube", low.alias("_low"), high.alias("_high"))
        most = F.nth_value("_high", k).over(W.partitionBy(key).orderBy("_high").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        front = step.withColumn("_most", most).where("_most is null or _low <= _most").select(key, "lat", "lon", *at.values(), F.col("cube").alias("_cube"))
    cost = haversine_m(F.col("lat"), F.col("lon"), F.col("la"), F.col("lo")) + F.col("extra")
    met = front.join(p, F.col("_cube") == F.col(f"c{len(TREE) - 1}")).select(key, "anchor", cost.alias("cost"))
    return met.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy("cost", "anchor"))).where(F.col("rank") <= k).select(key, "rank", "anchor", "cost")


def nearest_in_cells(probes: DataFrame, points: DataFrame, max_m: float, size: tuple[float, float], key: str = "probe", other: str = "point") -> DataFrame:
    """(key, other, d): the nearest point within max_m of each probe, by cells of size degrees; none gives no row. Ties to the smaller point.

    Places meet, each once: of the points of one place the smallest decides, and the probes of one place have one answer."""
    own = probes.select(key, F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")).where("_qlat is not null and _qlon is not null")
    q = _around(own.select("_qlat", "_qlon").distinct(), "_qlat", "_qlon", size)
    p = points.groupBy("lat", "lon").agg(F.min(other).alias(other)).withColumn("_cy", cell(F.col("lat"), size[0])).withColumn("_cx", cell(F.col("lon"), size[1]))
    d = haversine_m(F.col("_qlat"), F.col("_qlon"), F.col("lat"), F.col("lon"))
    met = q.join(p, ["_cy", "_cx"]).select("_qlat", "_qlon", other, d.alias("d")).where(F.col("d") <= max_m)
    best = met.groupBy("_qlat", "_qlon").agg(F.min(F.struct("d", other)).alias("b"))
    return own.join(best, ["_qlat", "_qlon"]).select(key, f"b.{other}", "b.d")


def edges_of(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    from ridgeline.operators.lines import along

    w = along(line, seq)
    return points.select(line, seq, "lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2")).where("lat2 is not null")


def cells_of_edges(edges: DataFrame, size: float) -> DataFrame:
    """A row for each cell of an edge's cell box and the ring around it."""
    ys = F.sequence(F.least(cell(F.col("lat"), size), cell(F.col("lat2"), size)) - 1, F.greatest(cell(F.col("lat"), size), cell(F.col("lat2"), size)) + 1)
    xs = F.sequence(F.least(cell(F.col("lon"), size), cell(F.col("lon2"), size)) - 1, F.greatest(cell(F.col("lon"), size), cell(F.col("lon2"), size)) + 1)
    return edges.withColumn("_cy", F.explode(ys)).withColumn("_cx", F.explode(xs))


def in_cell(points: DataFrame, size: float) -> DataFrame:
    """Points (_qlat, _qlon) with their own cell."""
    return points.withColumn("_cy", cell(F.col("_qlat"), size)).withColumn("_cx", cell(F.col("_qlon"), size))


def label_points(track: DataFrame, network: DataFrame, threshold_m: float, size: float = 0.004, line: str = "line", seq: str = "seq") -> DataFrame:
    """track rows (line, seq, lat, lon, ...) with label: the network line (cand, seq, lat, lon) nearest within the threshold, else null; d, edge and t of the projection.

    Places meet the network, each once: the points of one place have one answer."""
    e = cells_of_edges(edges_of(network, "cand", "seq").withColumnRenamed("seq", "edge"), size)
    q = in_cell(spread(track.select(F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")).where("_qlat is not null and _qlon is not null").distinct()), size)
    p = edge_projection((F.col("_qlat"), F.col("_qlon")), (F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")))
    met = q.join(e, ["_cy", "_cx"]).select("_qlat", "_qlon", "cand", "edge", p.alias("p")).where(F.col("p.d") <= threshold_m)
    best = met.groupBy("_qlat", "_qlon").agg(F.min(F.struct(F.col("p.d").alias("d"), "cand", "edge", F.col("p.t").alias("t"))).alias("b"))
    kept = [c for c in track.columns if c not in ("label", "d", "edge", "t")]
    labelled = track.join(best, (F.col("lat") == F.col("_qlat")) & (F.col("lon") == F.col("_qlon")), "left")
    return labelled.select(*kept, F.col("b.cand").alias("label"), "b.d", "b.edge", "b.t")


def overlapping_boxes(boxes: DataFrame, size: float, key: str = "line") -> DataFrame:
    """Pairs (a < b) of rows whose boxes (min_lat, min_lon, max_lat, max_lon) overlap, touching included; boxes meet in common cells and once each.

    Distinct boxes meet; the rows of two boxes that overlap, or of one box, are its pairs without another look."""
    corners = [f"{n}_{c}" for n in ("min", "max") for c in ("lat", "lon")]
    own = boxes.select(key, F.struct(*corners).alias("_box"))
    ys, xs = (F.sequence(cell(F.col(f"min_{c}"), size), cell(F.col(f"max_{c}"), size)) for c in ("lat", "lon"))
    tiled = boxes.select(*corners).distinct().withColumn("_cy", F.explode(ys)).withColumn("_cx", F.explode(xs)).select(F.struct(*corners).alias("l"), "_cy", "_cx")
    at = lambda b, c: F.col(f"{b}.{c}")
    over = [at("l", f"min_{c}") <= at("r", f"max_{c}") for c in ("lat", "lon")] + [at("r", f"min_{c}") <= at("l", f"max_{c}") for c in ("lat", "lon")]
    # the pair's own cell: that of the lower corner of what they share
    once = [F.col(t) == cell(F.greatest(at("l", f"min_{c}"), at("r", f"min_{c}")), size) for t, c in (("_cy", "lat"), ("_cx", "lon"))]
    met = tiled.join(tiled.withColumnRenamed("l", "r"), ["_cy", "_cx"]).where(F.col("l") <= F.col("r"))
    for holds in (*over, *once):
        met = met.where(holds)
    x, y = F.col("_x"), F.col("_y")
    left = shuffled(own.select(F.col(key).alias("_x"), F.col("_box").alias("l")))
    right = shuffled(own.select(F.col(key).alias("_y"), F.col("_box").alias("r")))
    each = met.select("l", "r", (F.col("l") == F.col("r")).alias("same")).join(left, "l").drop("l").join(right, "r")
    return each.where((x < y) | ((x > y) & ~F.col("same"))).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def covered_share(short: DataFrame, long: DataFrame, within_m: float, size: float = 0.002, line: str = "line", seq: str = "seq") -> DataFrame:
    """(a, b, near, n, share): of each line of short, the points within within_m of an edge of a line of long; lines never meet themselves, pairs without a near point are left out."""
    from ridgeline.functions.geo import edge_distance_m

    e = cells_of_edges(edges_of(long, line, seq).withColumnRenamed(line, "b").withColumnRenamed(seq, "edge"), size)
    q = in_cell(short.select(F.col(line).alias("a"), F.col(seq).alias("s"), F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")), size)
    d = edge_distance_m((F.col("_qlat"), F.col("_qlon")), (F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")))
    near = q.join(e, ["_cy", "_cx"]).where("a <> b").where(d <= within_m).select("a", "s", "b").distinct()
    hits = near.groupBy("a", "b").agg(F.count(F.lit(1)).alias("near"))
    size_of = short.groupBy(F.col(line).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    return hits.join(size_of, "a").withColumn("share", F.col("near") / F.col("n"))
