"""Recorded tracks against a network of known lines: which stretch rode which line, which way.

One cell join finds each point's nearest line within the loose threshold; the strict label is the same line where it is
near enough. A track's spacing turns metres into points, so windows, gaps and least lengths are columns; none is longer
than the track. Votes are an aggregate over the places each point votes for; runs, their merging and turns are windows by
track. Points with their labels, and with each pass's votes, are tables that later steps read. No track is gathered.

Cases: a track that stands still, or has one point, has windows as long as itself; a track without points, or a network
without lines, gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.geo import edge_projection, haversine_m
from ridgeline.operators.lines import along, cumulative_km, line_measures
from ridgeline.operators.nearest import cells_of_edges, edges_of, in_cell, label_points
from ridgeline.operators.runs import run_lengths
from ridgeline.operators.settle import settled

# Metres of the strict and loose radius, of the vote, of gaps that merging bridges, of the shortest run, of
# the shortest open stretch that the second pass takes, of a turn's sides; the share of a line's own length that is enough.
STRICT_M, LOOSE_M, SMOOTH_M, GAP_M, RUN_M, SECOND_M, TURN_M, TURN_KM, OWN_SHARE = 15.0, 35.0, 150.0, 670.0, 268.0, 804.0, 150.0, 0.1, 0.5


def in_points(metres: float, spacing: Column, least: int, of: Column) -> Column:
    """Metres as a number of points, `least` at least, and no more than one beyond all `of` points of the track; halves go to the even number."""
    n = F.least(F.bround(F.lit(float(metres)) / spacing), (of + 1).cast("double")).cast("int")
    return F.when(n > least, n).otherwise(least)


def by_vote(points: DataFrame, label: str, half: Column) -> DataFrame:
    """points (line, seq, ...) with voted: the most frequent label within `half` places on both sides; null is a label,
    and of equally frequent ones the first along the line wins."""
    around = F.transform(F.sequence(-half, half), lambda o: F.col("seq") + o)
    votes = points.select("line", F.explode(around).alias("at"), F.col(label).alias("_l"), "seq")
    counted = votes.groupBy("line", "at", "_l").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("f"))
    best = counted.groupBy(F.col("line").alias("_line"), "at").agg(F.max_by(F.struct("_l"), F.struct("n", -F.col("f"))).alias("b"))
    met = points.join(best, (F.col("line") == F.col("_line")) & (F.col("seq") == F.col("at")))
    return met.select(*points.columns, F.col("b._l").alias("voted"))


def long_runs(voted: DataFrame, sizes: DataFrame, own_m: DataFrame) -> DataFrame:
    """(line, label, a, b) of labels `voted`: neighbours with one label and at most `gap` places between them are one run;
    those stay that have `least` points, or half the points of the label's own line."""
    named = run_lengths(voted, "voted").where("label is not null").join(sizes, "line")
    w = along("line", "a")
    on = (F.col("label") == F.lag("label").over(w)) & (F.col("a") - F.lag("b").over(w) <= F.col("gap"))
    joined = named.withColumn("k", F.sum(F.when(on, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    whole = joined.groupBy("line", "k").agg(F.first("label").alias("label"), F.min("a").alias("a"), F.max("b").alias("b"), F.first("least").alias("least"), F.first("spacing_m").alias("spacing_m"))
    sized = whole.join(own_m.select(F.col("cand").alias("label"), F.col("length_m").alias("own_m")), "label", "left")
    n, own = F.col("b") - F.col("a") + 1, F.col("own_m") / F.col("spacing_m") * OWN_SHARE
    return sized.where((n >= F.col("least")) | (n >= own)).select("line", "label", "a", "b")


def inside(points: DataFrame, runs: DataFrame) -> DataFrame:
    """points with in_run: whether a run (line, a, b) holds them."""
    held = runs.select(F.col("line").alias("_line"), F.explode(F.sequence("a", "b")).alias("_seq")).distinct()
    met = points.join(held, (F.col("line") == F.col("_line")) & (F.col("seq") == F.col("_seq")), "left")
    return met.select(*points.columns, F.col("_seq").isNotNull().alias("in_run"))


def two_pass_runs(labelled: DataFrame, own_m: DataFrame, *, strict_m: float = STRICT_M, smooth_m: float = SMOOTH_M, gap_m: float = GAP_M, run_m: float = RUN_M, second_m: float = SECOND_M) -> DataFrame:
    """(line, run, cand, a, b) from points (line, seq, label, d, spacing_m), label being the nearest line within the loose
    radius and d its distance. Strict labels first; stretches that stay open for second_m then take the loose ones."""
    spacing, n = F.col("spacing_m"), F.col("n")
    half = F.floor(in_points(smooth_m, spacing, 3, n) / 2).cast("int")  # an even window is one wider
    sizes = labelled.groupBy("line").agg(F.max("spacing_m").alias("spacing_m"), F.count(F.lit(1)).alias("n")).select(
        "line", "spacing_m", in_points(gap_m, spacing, 1, n).alias("gap"), in_points(run_m, spacing, 2, n).alias("least"), in_points(second_m, spacing, 1, n).alias("open_points"), half.alias("half")
    )
    sizes = settled(sizes, "sizes")
    points = labelled.select("line", "seq", "label", F.when(F.col("d") <= strict_m, F.col("label")).alias("strict")).join(sizes.select("line", "half"), "line")
    first = settled(by_vote(points, "strict", F.col("half")), "first")
    marked = inside(first, long_runs(first, sizes, own_m))
    state = run_lengths(marked, "in_run").where("not label").join(sizes.select("line", "open_points"), "line").where(F.col("b") - F.col("a") + 1 >= F.col("open_points"))
    again = inside(first, state.select("line", "a", "b")).withColumn("mixed", F.when(F.col("in_run"), F.col("label")).otherwise(F.col("voted"))).drop("voted", "in_run")
    again = settled(again, "again")
    runs = long_runs(by_vote(again, "mixed", F.col("half")), sizes, own_m)
    return runs.select("line", (F.row_number().over(along("line", "a")) - 1).alias("run"), F.col("label").alias("cand"), "a", "b")


def ridden(at: DataFrame, *, turn_m: float = TURN_M, turn_km: float = TURN_KM) -> DataFrame:
    """(line, run, cand, a, b, reversed, from_km, to_km) from places (line, run, cand, seq, km, spacing_m): a run whose place
    has its top, else its bottom, with enough points and way on both sides is two, out and back."""
    w = W.partitionBy("line", "run")
    n, i = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy("seq")) - 1
    p = at.select("line", "run", "cand", "seq", "km", in_points(turn_m, F.col("spacing_m"), 2, n).alias("side"), n.alias("n"), i.alias("i"))
    place = F.struct("i", "km")
    of_run = p.groupBy("line", "run").agg(F.max_by(place, F.struct("km", -F.col("i"))).alias("top"), F.min_by(place, F.struct("km", "i")).alias("low"), F.min_by("km", "i").alias("k0"), F.max_by("km", "i").alias("k1"), F.first("side").alias("side"), F.first("n").alias("n"))
    turns = lambda x: (F.col(f"{x}.i") >= F.col("side")) & (F.col("n") - F.col(f"{x}.i") >= F.col("side")) & (F.abs(F.col(f"{x}.km") - F.col("k0")) >= turn_km) & (F.abs(F.col(f"{x}.km") - F.col("k1")) >= turn_km)
    cut = of_run.select(F.col("line").alias("_line"), F.col("run").alias("_run"), F.when(turns("top"), F.col("top.i")).when(turns("low"), F.col("low.i")).alias("turn"))
    met = p.join(cut, (F.col("line") == F.col("_line")) & (F.col("run") == F.col("_run")))
    part = F.when(F.col("i") > F.col("turn"), 1).otherwise(0)
    ends = met.groupBy("line", "run", "cand", part.alias("part")).agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.min_by("km", "seq").alias("from_km"), F.max_by("km", "seq").alias("to_km"))
    return ends.select("line", "run", "cand", "a", "b", (F.col("to_km") < F.col("from_km")).alias("reversed"), "from_km", "to_km")


def places(runs: DataFrame, track: DataFrame, network: DataFrame, near_m: float = LOOSE_M, size: float = 0.004) -> DataFrame:
    """(line, run, cand, seq, km): each run's points projected on the run's line: by cells where an edge of it lies within near_m,
    which a cell's side of `size` degrees must exceed; the few other points meet all its edges."""
    km = cumulative_km(network, "cand", "seq").select(F.col("cand").alias("_c"), F.col("seq").alias("_s"), F.col("km").alias("km0"))
    edges = edges_of(network, "cand", "seq").join(km, (F.col("cand") == F.col("_c")) & (F.col("seq") == F.col("_s"))).select("_c", F.col("seq").alias("edge"), "lat", "lon", "lat2", "lon2", "km0")
    rows = settled(runs.withColumn("seq", F.explode(F.sequence("a", "b"))).join(track.select("line", "seq", F.col("lat").alias("_qlat"), F.col("lon").alias("_qlon")), ["line", "seq"]), "ridden")
    keys = ["line", "run", "cand", "seq"]

    def best(met: DataFrame) -> DataFrame:
        p = edge_projection((F.col("_qlat"), F.col("_qlon")), (F.col("lat"), F.col("lon")), (F.col("lat2"), F.col("lon2")))
        at = F.col("km0") + F.col("p.t") * haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) / 1000
        return met.withColumn("p", p).groupBy(*keys).agg(F.min(F.struct(F.col("p.d").alias("d"), "edge", at.alias("km"))).alias("b"))

    here = in_cell(rows, size).withColumn("_c", F.col("cand"))
    near = settled(best(here.join(cells_of_edges(edges, size), ["_c", "_cy", "_cx"])).where(F.col("b.d") <= near_m), "near")
    rest = rows.join(near.select(*keys), keys, "left_anti")
    return near.unionByName(best(rest.join(edges, F.col("cand") == F.col("_c")))).select(*keys, "b.km")


def matched(track: DataFrame, network: DataFrame, *, loose_m: float = LOOSE_M, turn_m: float = TURN_M, size: float = 0.004, **options) -> DataFrame:
    """(line, run, cand, a, b, reversed, from_km, to_km) in ride order. track (line, seq, lat, lon), seq from 0 without gaps;
    network (cand, seq, lat, lon) has trails and lifts; size is the cells' side in degrees, over the loose radius."""
    own = line_measures(network, "cand", "seq").select("cand", "length_m")
    spacing = line_measures(track).select("line", F.when(F.col("spacing_m") > 1e-9, F.col("spacing_m")).otherwise(1e-9).alias("spacing_m"))
    spacing = settled(spacing, "spacing")
    labelled = settled(label_points(track.select("line", "seq", "lat", "lon"), network, loose_m, size).join(spacing, "line"), "labelled")
    runs = two_pass_runs(labelled, own, **options)
    return ridden(settled(places(runs, track, network, loose_m, size), "places").join(spacing, "line"), turn_m=turn_m)


def extended(matches: DataFrame, track: DataFrame, network: DataFrame, within_m: float = 60.0, around: int = 40) -> DataFrame:
    """matches with lo_km and hi_km: the ridden range, drawn out to an end of the line that the track passes within
    within_m of, from `around` points before the run to as many after it."""
    ends = cumulative_km(network, "cand", "seq").groupBy("cand").agg(F.min_by(F.struct("lat", "lon"), "seq").alias("s"), F.max_by(F.struct("lat", "lon"), "seq").alias("e"), F.max("km").alias("total"))
    near = matches.join(ends.withColumnRenamed("cand", "_c"), F.col("cand") == F.col("_c")).drop("_c")
    window = near.withColumn("seq", F.explode(F.sequence(F.greatest(F.col("a") - around, F.lit(0).cast(dict(matches.dtypes)["a"])), F.col("b") + around)))
    rows = window.join(track.select("line", "seq", "lat", "lon"), ["line", "seq"])
    d = lambda k: F.min(haversine_m(F.col(f"{k}.lat"), F.col(f"{k}.lon"), F.col("lat"), F.col("lon"))) <= within_m
    keys = ["line", "run", "cand", "a", "b", "reversed", "from_km", "to_km", "total"]
    got = rows.groupBy(*keys).agg(d("s").alias("at_start"), d("e").alias("at_end"))
    lo, hi = F.least("from_km", "to_km"), F.greatest("from_km", "to_km")
    return got.select(*keys[:-1], F.when(F.col("at_start"), 0.0).otherwise(lo).alias("lo_km"), F.when(F.col("at_end"), F.col("total")).otherwise(hi).alias("hi_km"))
