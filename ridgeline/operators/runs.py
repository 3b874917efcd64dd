"""Labels along a line: majority vote, run lengths, consolidation, joints. One shuffle by line carries them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.geo import haversine_m
from ridgeline.operators.lines import along


def majority(points: DataFrame, window: int = 11, label: str = "label", line: str = "line", seq: str = "seq") -> DataFrame:
    """voted: the most frequent label of the centred window (cut off at the ends); null votes like any other, the first seen wins ties."""
    half = window // 2
    votes = F.collect_list(F.struct(F.col(label).alias("l"))).over(along(line, seq).rowsBetween(-half, half))
    first = F.filter(F.col("_v"), lambda x, i: F.array_position(F.col("_v"), x) == i + 1)
    counted = F.transform(first, lambda x: F.struct(F.size(F.filter(F.col("_v"), lambda y: y == x)).alias("n"), (-F.array_position(F.col("_v"), x)).alias("p"), x.alias("x")))
    return points.withColumn("_v", votes).withColumn("voted", F.array_max(counted)["x"]["l"]).drop("_v")


def run_lengths(points: DataFrame, label: str = "label", line: str = "line", seq: str = "seq") -> DataFrame:
    """Maximal runs of equal labels, null included: line, run, label, a, b (first and last seq)."""
    w = along(line, seq)
    new = F.when(F.row_number().over(w) == 1, 1).when(F.col(label).eqNullSafe(F.lag(label).over(w)), 0).otherwise(1)
    runs = points.withColumn("run", F.sum(new).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(line, "run").agg(F.first(label).alias("label"), F.min(seq).alias("a"), F.max(seq).alias("b"))


def consolidated(runs: DataFrame, gap: int, least: int, own_length: DataFrame | None = None, fraction: float = 0.5, line: str = "line") -> DataFrame:
    """Runs without null labels; neighbours with one label and at most `gap` between them are one; then those of at least
    min(least, fraction of the label's own length) points stay. own_length: (label, points)."""
    named = runs.where("label is not null")
    w = along(line, "a")
    new = F.when((F.col("label") == F.lag("label").over(w)) & (F.col("a") - F.lag("b").over(w) <= gap), 0).otherwise(1)
    merged = named.withColumn("k", F.sum(new).over(w.rowsBetween(W.unboundedPreceding, 0))).groupBy(line, "k").agg(F.first("label").alias("label"), F.min("a").alias("a"), F.max("b").alias("b"))
    floor = F.lit(float(least))
    if own_length is not None:
        merged = merged.join(own_length.select("label", F.col("points").alias("own")), "label", "left")
        floor = F.when(F.col("own") * fraction < least, F.col("own") * fraction).otherwise(floor)
    return merged.where(F.col("b") - F.col("a") + 1 >= floor).select(line, "label", "a", "b")


def joint_gaps(segments: DataFrame, threshold_m: float, wrap: bool = True, line: str = "line", seq: str = "seq") -> DataFrame:
    """Joints of a line's segments (start_lat, start_lon, end_lat, end_lon) farther apart than the threshold: seq, next_seq, gap_m.

    With wrap the last one's end and the first one's start are a joint too, in lines of two segments or more.
    """
    w, whole = along(line, seq), W.partitionBy(line)
    last = F.lead(seq).over(w).isNull()
    full = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    to = {c: F.coalesce(F.lead(c).over(w), F.first(c).over(full)) for c in (seq, "start_lat", "start_lon")}
    joints = segments.select(line, seq, to[seq].alias("next_seq"), haversine_m(F.col("end_lat"), F.col("end_lon"), to["start_lat"], to["start_lon"]).alias("gap_m"), last.alias("_last"), F.count(F.lit(1)).over(whole).alias("_n"))
    return joints.where((F.col("gap_m") > threshold_m) & (~F.col("_last") | (F.lit(wrap) & (F.col("_n") > 1)))).select(line, seq, "next_seq", "gap_m")


def direction_split(points: DataFrame, position: str = "position", least_points: int = 3, least: float = 0.1, line: str = "line", seq: str = "seq") -> DataFrame:
    """turn: where a run's position along its line has its inner maximum, else minimum, with least_points and `least` on both sides; null if nowhere."""
    w = W.partitionBy(line)
    n, i = F.count(F.lit(1)).over(w), F.row_number().over(along(line, seq))
    ends = along(line, seq).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    marked = points.select(line, seq, position, n.alias("n"), i.alias("i"), F.first(position).over(ends).alias("p0"), F.last(position).over(ends).alias("p1"))
    inner = marked.where((F.col("i") > least_points) & (F.col("i") <= F.col("n") - least_points))
    top = F.max_by(F.struct(seq, position, "p0", "p1"), F.struct(F.col(position), -F.col("i")))
    low = F.min_by(F.struct(seq, position, "p0", "p1"), F.struct(F.col(position), F.col("i")))
    found = inner.groupBy(line).agg(top.alias("t"), low.alias("l"))
    good_top = (F.col("t")[position] - F.col("t.p0") >= least) & (F.col("t")[position] - F.col("t.p1") >= least)
    good_low = (F.col("l.p0") - F.col("l")[position] >= least) & (F.col("l.p1") - F.col("l")[position] >= least)
    return points.select(line).distinct().join(found.select(line, F.when(good_top, F.col("t")[seq]).when(good_low, F.col("l")[seq]).alias("turn")), line, "left")
