"""Lines as rows (line, order, lat, lon, ele): measures, cuts, resampling, simplification.

Each operator shuffles once, by line; windows are always partitioned by line. Folds that depend on the last kept
point run per line in Python, one line in memory at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.geo import EARTH_M, M_PER_LAT, M_PER_LON, haversine_m


def along(line: str, *order: str):
    return W.partitionBy(line).orderBy(*order)


def with_steps(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """step_m: metres from the point before; null for a line's first."""
    w = along(line, seq)
    return points.withColumn("step_m", haversine_m(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")))


def cumulative_km(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """km: distance along the line, 0 at its start."""
    w = along(line, seq).rowsBetween(W.unboundedPreceding, 0)
    return with_steps(points, line, seq).withColumn("km", F.sum(F.coalesce("step_m", F.lit(0.0))).over(w) / 1000)


def line_measures(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """Per line: n, length_m, bounds and the mean spacing length / n."""
    return with_steps(points, line, seq).groupBy(line).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("step_m", F.lit(0.0))).alias("length_m"),
        *(f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")),
        (F.sum(F.coalesce("step_m", F.lit(0.0))) / F.count(F.lit(1))).alias("spacing_m"),
    )


def split_on_gaps(points: DataFrame, max_gap_m: float = 120.0, line: str = "line", seq: str = "seq") -> DataFrame:
    """Pieces between steps over max_gap_m: line, piece (0 up along the line), first, last, n, length_m, rank (longest first, then along the line)."""
    jumps = F.when(F.col("step_m") > max_gap_m, 1).otherwise(0)
    cut = with_steps(points, line, seq).withColumn("piece", F.sum(jumps).over(along(line, seq).rowsBetween(W.unboundedPreceding, 0)))
    inside = F.sum(F.when(F.col("step_m") > max_gap_m, 0.0).otherwise(F.coalesce("step_m", F.lit(0.0))))
    pieces = cut.groupBy(line, "piece").agg(F.min(seq).alias("first"), F.max(seq).alias("last"), F.count(F.lit(1)).alias("n"), inside.alias("length_m"))
    return pieces.withColumn("rank", F.row_number().over(W.partitionBy(line).orderBy(F.round("length_m", 6).desc(), "piece")))


def densify(points: DataFrame, step_m: float, line: str = "line", seq: str = "seq") -> DataFrame:
    """Every edge in max(1, floor(length / step_m)) parts, the line's end once. Rows: line, seq (of the edge's start), k, lat, lon."""
    w = along(line, seq)
    edges = points.select(line, seq, "lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2"))
    parts = F.greatest(F.lit(1), F.floor(haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) / step_m).cast("int"))
    last = F.col("lat2").isNull()
    dense = edges.withColumn("parts", F.when(last, 1).otherwise(parts)).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    at = lambda a, b: F.when(last, F.col(a)).otherwise(F.col(a) + (F.col(b) - F.col(a)) * F.col("k") / F.col("parts"))
    return dense.select(line, seq, "k", at("lat", "lat2").alias("lat"), at("lon", "lon2").alias("lon"))


def clean_elevation(points: DataFrame, smooth: int = 2, line: str = "line", seq: str = "seq") -> DataFrame:
    """filled and smoothed: heights near zero count as missing unless the whole line is, gaps take the height before, else
    the one after, else 0; then a centred mean, cut off at the ends."""
    whole, w = W.partitionBy(line), along(line, seq)
    flat = F.min(F.coalesce(F.abs("ele") < 0.5, F.lit(True)).cast("int")).over(whole) == 1
    known = F.when(flat | (F.abs("ele") >= 0.5), F.col("ele"))
    filled = F.coalesce(F.last("known", True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.first("known", True).over(w.rowsBetween(0, W.unboundedFollowing)), F.lit(0.0))
    out = points.withColumn("known", known).withColumn("filled", filled).drop("known")
    return out.withColumn("smoothed", F.avg("filled").over(w.rowsBetween(-smooth, smooth)))


def resample(points: DataFrame, line: str = "line", seq: str = "seq", value: str = "smoothed") -> DataFrame:
    """profile rows (line, k, km, ele): 100, 150 or 200 samples by length (under 7, under 25 km), linear between points.

    points need km and value. An edge makes just the samples in its own stretch (samples before its start are
    dropped as k is computed), so nothing is joined and nothing grows with samples times points.
    """
    w, whole = along(line, seq), W.partitionBy(line)
    total = F.max("km").over(whole)
    n = F.when(total < 7, 100).when(total < 25, 150).otherwise(200)
    edges = points.select(line, seq, "km", F.col(value).alias("v"), F.lead("km").over(w).alias("km2"), F.lead(value).over(w).alias("v2"), total.alias("total"), n.alias("n"), F.lag("km").over(w).alias("km0"))
    edges = edges.where("km2 > km and total > 0")
    # samples k with km < total * k / (n - 1) <= km2, and k = 0 for the first edge
    place = lambda k: F.col("total") * k / (F.col("n") - 1)
    lo = F.greatest(F.lit(0), F.floor(F.col("km") * (F.col("n") - 1) / F.col("total")).cast("int") - 1)
    hi = F.least(F.col("n") - 1, F.ceil(F.col("km2") * (F.col("n") - 1) / F.col("total")).cast("int") + 1)
    cut = edges.withColumn("k", F.explode(F.sequence(lo, hi))).withColumn("at", F.when(F.col("k") == F.col("n") - 1, F.col("total")).otherwise(place(F.col("k"))))
    inside = (F.col("at") > F.col("km")) & (F.col("at") <= F.col("km2")) | (F.col("k") == 0) & (F.col("km") == 0)
    return cut.where(inside).select(line, "k", F.col("at").alias("km"), (F.col("v") + (F.col("at") - F.col("km")) / (F.col("km2") - F.col("km")) * (F.col("v2") - F.col("v"))).alias("ele"))


def gain_loss(profile: DataFrame, line: str = "line", order: str = "k") -> DataFrame:
    """gain and loss in whole metres, from heights in tenths added up as integers."""
    tenths = F.round(F.col("ele") * 10).cast("long")
    rise = tenths - F.lag(tenths).over(along(line, order))
    steps = profile.withColumn("rise", F.coalesce(rise, F.lit(0)))
    return steps.groupBy(line).agg(
        F.round(F.sum(F.when(F.col("rise") > 0, F.col("rise")).otherwise(0)) / 10).cast("long").alias("gain"), F.round(F.sum(F.when(F.col("rise") < 0, -F.col("rise")).otherwise(0)) / 10).cast("long").alias("loss")
    )


def uphill(points: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """Whether a line climbs: over 30 m net, and one and a half times as much up as down, on its known heights."""
    known = points.where("ele is not null")
    rise = F.col("ele") - F.lag("ele").over(along(line, seq))
    steps = known.withColumn("rise", F.coalesce(rise, F.lit(0.0)))
    up = F.sum(F.when(F.col("rise") > 0, F.col("rise")).otherwise(0.0))
    down = F.sum(F.when(F.col("rise") < 0, -F.col("rise")).otherwise(0.0))
    ends = F.max_by("ele", seq) - F.min_by("ele", seq)
    found = steps.groupBy(line).agg(up.alias("up_m"), down.alias("down_m"), ends.alias("net_m"))
    all_lines = points.select(line).distinct()
    climbs = F.coalesce((F.col("net_m") > 30) & (F.col("up_m") > 1.5 * F.col("down_m")), F.lit(False))
    return all_lines.join(found, line, "left").withColumn("uphill", climbs)


def looks(points: DataFrame, line: str = "line") -> DataFrame:
    """Unweighted mean of a line's points."""
    return points.groupBy(line).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def haversine_np(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Metres between rows of (lat, lon)."""
    p, q = np.radians(a), np.radians(b)
    x = np.sin((q[..., 0] - p[..., 0]) / 2) ** 2 + np.cos(p[..., 0]) * np.cos(q[..., 0]) * np.sin((q[..., 1] - p[..., 1]) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(x, 1)))


def _per_line(points: DataFrame, line: str, seq: str, keep: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq, kind="stable")
        return pdf[keep(pdf[["lat", "lon"]].to_numpy(float))]

    return points.groupBy(line).applyInPandas(run, points.schema)


def kept_by_spacing(xy: np.ndarray, spacing_m: float) -> np.ndarray:
    keep = np.zeros(len(xy), bool)
    last = None
    for i in range(len(xy)):
        if last is None or haversine_np(xy[last], xy[i]) > spacing_m:
            keep[i], last = True, i
    return keep


def min_spacing(points: DataFrame, spacing_m: float = 0.5, line: str = "line", seq: str = "seq") -> DataFrame:
    """Points farther than spacing_m from the last one kept."""
    return _per_line(points, line, seq, lambda xy: kept_by_spacing(xy, spacing_m))


def kept_by_shape(xy: np.ndarray, eps_m: float) -> np.ndarray:
    keep = np.zeros(len(xy), bool)
    if len(xy):
        keep[[0, -1]] = True
    todo = [(0, len(xy) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        # differences before products: places as numbers of metres would cost a nanometre, which parts equal deviations
        to, (dy, dx) = xy[a + 1 : b] - xy[a], xy[b] - xy[a]
        cos = np.cos(np.radians(xy[a, 0]))
        length = np.sqrt((dx * cos * M_PER_LON) ** 2 + (dy * M_PER_LAT) ** 2)
        if length == 0:
            x = np.sin(np.radians(to[:, 0]) / 2) ** 2 + np.cos(np.radians(xy[a + 1 : b, 0])) * cos * np.sin(np.radians(to[:, 1]) / 2) ** 2
            d = 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(x, 1)))
        else:
            d = np.abs(dy * M_PER_LAT * to[:, 1] * cos * M_PER_LON - dx * cos * M_PER_LON * to[:, 0] * M_PER_LAT) / length
        k = int(np.floor(d * 1e6 + 0.5).argmax())  # to a micrometre, so that equal deviations go to the first
        if d.max() > eps_m:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def douglas_peucker(points: DataFrame, eps_m: float = 2.0, line: str = "line", seq: str = "seq") -> DataFrame:
    """Points that deviate by more than eps_m from the chord of those kept around them."""
    return _per_line(points, line, seq, lambda xy: kept_by_shape(xy, eps_m))


def chained(pieces: list[np.ndarray], tol_m: float = 25.0) -> tuple[np.ndarray, list[int]]:
    """(line, indices left over): from the longest piece on, the first that fits at the tail, else at the head, either way round."""
    left = list(range(len(pieces)))
    if not left:
        return np.zeros((0, 2)), left
    size = [haversine_np(p[:-1], p[1:]).sum() for p in pieces]
    start = max(left, key=lambda i: (size[i], -i))
    left.remove(start)
    line, found = pieces[start], True
    while found:
        found = False
        for at_tail in (True, False):
            end = line[-1] if at_tail else line[0]
            for i in left:
                p = pieces[i]
                flip = None
                if haversine_np(end, p[0]) <= tol_m:
                    flip = not at_tail
                elif haversine_np(end, p[-1]) <= tol_m:
                    flip = at_tail
                if flip is None:
                    continue
                p = p[::-1] if flip else p
                line = np.concatenate([line, p[1:]]) if at_tail else np.concatenate([p[:-1], line])
                left.remove(i)
                found = True
                break
            if found:
                break
    return line, left


def distance_stamps(points: DataFrame, segment: Column, line: str = "line", seq: str = "seq") -> DataFrame:
    """dist_start and dist_end in km to 3 places of each stretch of a line's points with equal `segment`."""
    return cumulative_km(points.withColumn("_segment", segment), line, seq).groupBy(line, F.col("_segment").alias("segment")).agg(F.round(F.min("km"), 3).alias("dist_start"), F.round(F.max("km"), 3).alias("dist_end"))


def value_at(profile: DataFrame, places: DataFrame, line: str = "line", x: str = "km", y: str = "ele") -> DataFrame:
    """Linear value at each place (line, at) of a profile (line, x, y), clamped at both ends.

    Profile and places are one sorted stream a line, so each place takes its neighbours from a window; no range join.
    """
    rows = profile.select(line, F.col(x).alias("at"), F.col(x).alias("px"), F.col(y).alias("py"), F.lit(0).alias("kind")).unionByName(places.select(line, "at", F.lit(None).cast("double").alias("px"), F.lit(None).cast("double").alias("py"), F.lit(1).alias("kind")))
    w = along(line, "at", "kind")
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    got = rows.select("*", *(f(c, True).over(s).alias(f"{c}{k}") for k, f, s in ((0, F.last, back), (1, F.first, ahead)) for c in ("px", "py"))).where("kind = 1")
    mid = F.col("py0") + (F.col("at") - F.col("px0")) / (F.col("px1") - F.col("px0")) * (F.col("py1") - F.col("py0"))
    return got.select(line, "at", F.when(F.col("px0").isNull(), F.col("py1")).when(F.col("px1").isNull() | (F.col("px1") == F.col("px0")), F.col("py0")).otherwise(mid).alias(y))


def flattened(rows: DataFrame, nested: str, line: str = "line") -> DataFrame:
    """(line, k, v): the values of nested arrays in order."""
    return rows.select(line, F.posexplode(F.flatten(nested)).alias("k", "v"))


def cut_by_index(points: DataFrame, cuts: DataFrame, line: str = "line", seq: str = "seq") -> DataFrame:
    """points of each line's pieces (line, piece, lo, hi), from lo up to but without hi, with k from 0 in each piece."""
    c = cuts.select(F.col(line).alias("_l"), "piece", "lo", "hi")
    met = points.join(c, (F.col(line) == F.col("_l")) & (F.col(seq) >= F.col("lo")) & (F.col(seq) < F.col("hi")))
    return met.select(*points.columns, "piece", (F.col(seq) - F.col("lo")).alias("k"))


def chained_ways(pieces: DataFrame, tol_m: float = 25.0, group: str = "group") -> DataFrame:
    """(group, seq, lat, lon, left_over): each group's pieces (group, piece, seq, lat, lon) as one line from the longest piece on;
    left_over counts the pieces that fit nowhere. A group is one named line, which a task holds."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [g.sort_values("seq", kind="stable")[["lat", "lon"]].to_numpy(float) for _, g in pdf.groupby("piece", sort=True)]
        line, left = chained(parts, tol_m)
        return pd.DataFrame({group: pdf[group].iloc[0], "seq": np.arange(len(line)), "lat": line[:, 0], "lon": line[:, 1], "left_over": len(left)})

    return pieces.groupBy(group).applyInPandas(run, f"{group} {dict(pieces.dtypes)[group]}, seq long, lat double, lon double, left_over long")


def chained_sections(pieces: DataFrame, limit_m: float, line: str = "line") -> DataFrame:
    """(line, piece, flipped, joint_m, ok): sections (line, piece, a_lat, a_lon, b_lat, b_lon) in their order, each turned so that
    its nearer end follows the one before; ok is false where a joint is over limit_m, which a caller may refuse."""

    def step(acc: Column, p: Column) -> Column:
        to_a, to_b = (haversine_m(acc["lat"], acc["lon"], p[f"{x}_lat"], p[f"{x}_lon"]) for x in ("a", "b"))
        flip = F.coalesce(to_b < to_a, F.lit(False))
        joint = F.when(flip, to_b).otherwise(to_a)
        row = F.struct(p["piece"].alias("piece"), flip.alias("flipped"), joint.alias("joint_m"))
        end = lambda c: F.when(flip, p[f"a_{c}"]).otherwise(p[f"b_{c}"])
        return F.struct(end("lat").alias("lat"), end("lon").alias("lon"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    kind = dict(pieces.dtypes)["piece"]
    start = F.struct(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.array().cast(f"array<struct<piece: {kind}, flipped: boolean, joint_m: double>>").alias("rows"))
    each = pieces.groupBy(line).agg(F.sort_array(F.collect_list(F.struct("piece", "a_lat", "a_lon", "b_lat", "b_lon"))).alias("ps"))
    rows = each.select(line, F.explode(F.aggregate("ps", start, step)["rows"]).alias("r")).select(line, "r.*")
    return rows.withColumn("ok", F.coalesce(F.col("joint_m") <= limit_m, F.lit(True)))


def built_trails(points: DataFrame, known: DataFrame, spacing_m: float = 0.5, eps_m: float = 2.0, climb_m: float = 15.0, line: str = "line", seq: str = "seq") -> DataFrame:
    """(line, k, lat, lon, ele): raw points without near repeats, simplified, heights filled from a cache, turned where they climb
    more than climb_m from end to end, rounded to 6 places."""
    from ridgeline.sources.scans import elevations

    p = douglas_peucker(min_spacing(points, spacing_m, line, seq), eps_m, line, seq)
    p = elevations(p, known).withColumn("ele", F.coalesce("ele", "ele_found"))
    whole = along(line, seq).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    climbs = F.coalesce(F.last("ele", True).over(whole) - F.first("ele", True).over(whole) > climb_m, F.lit(False))
    turned = p.withColumn("_o", F.when(climbs, -F.col(seq)).otherwise(F.col(seq)))
    return turned.withColumn("k", F.row_number().over(along(line, "_o")) - 1).select(line, "k", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "ele")
