"""Rules, rankings and greedy selections."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.operators.lines import haversine_np

# Tag values that open or close a way to bicycles, and the surcharge in metres of a way's type.
ALLOWED = ("yes", "designated", "permissive", "official")
BLOCKING = {"bicycle": ("no", "private", "dismount"), "access": ("private", "no", "permit", "customers"), "vehicle": ("private", "no", "forestry", "agricultural", "delivery")}
PENALTY_M = {"path": 0, "footway": 0, "cycleway": 0, "bridleway": 0, "track": 6, "service": 10, "residential": 10, "unclassified": 20, "tertiary": 20, "secondary": 20, "primary": 20}
OTHER_PENALTY_M = 12
DIFFICULTIES = ("gruen", "blau", "rot", "schwarz")


def blocked_reason(tags: Column) -> Column:
    """'key=value' of the first rule that closes a way, null if it is open. An explicit bicycle permission wins."""
    out = F.when(F.coalesce(tags["bicycle"].isin(*ALLOWED), F.lit(False)), F.lit(None).cast("string"))
    for key, values in BLOCKING.items():
        out = out.when(tags[key].isin(*values), F.concat(F.lit(key + "="), tags[key]))
    return out


def type_penalty(highway: Column) -> Column:
    out = F.lit(float(OTHER_PENALTY_M))
    for kind, m in PENALTY_M.items():
        out = F.when(highway == kind, float(m)).otherwise(out)
    return out


def bridge_cost(off_m: Column, trim_m: Column, route_m: Column, beeline_m: Column, residual_m: Column) -> Column:
    """Penalty metres: 3 off the ways, 0.3 trimmed, 1 detour, 5 residual; over 250 m trimmed is infinite."""
    detour = F.when(route_m > beeline_m, route_m - beeline_m).otherwise(0.0)
    return F.when(trim_m > 250, F.lit(float("inf"))).otherwise(3 * off_m + 0.3 * trim_m + detour + 5 * residual_m)


def ranked_candidates(c: DataFrame, gap: str = "gap") -> DataFrame:
    """rank within each gap: not rejected first, then off, the case's first character, double metres by tens, length with
    trimming, trimming, length; half-even rounding; the candidate's number breaks ties."""
    key = (F.col("reject").isNotNull(), F.bround("off"), F.substring("case", 1, 1), F.bround(F.col("dbl") / 10), F.bround(F.col("len") + F.col("trim")), F.col("trim"), F.col("len"), F.col("no"))
    return c.withColumn("rank", F.row_number().over(W.partitionBy(gap).orderBy(*key)))


def tiered_choice(c: DataFrame, gap: str = "gap") -> DataFrame:
    """The shortest route of the lowest tier that has any, for each gap."""
    return c.withColumn("_r", F.row_number().over(W.partitionBy(gap).orderBy("tier", "route_m", "no"))).where("_r = 1").drop("_r")


def hardest(sections: DataFrame, key: str, difficulty: str = "diff", order: tuple[str, ...] = DIFFICULTIES) -> DataFrame:
    """The hardest difficulty of each key's sections; unknown ones count for nothing."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(difficulty))
    top = F.max(F.when(rank > 0, rank))
    return sections.groupBy(key).agg(F.try_element_at(F.array(*map(F.lit, order)), top.cast("int")).alias(difficulty))


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """The first rule that holds names the reason; null if none does."""
    out = F.lit(None).cast("string")
    for reason, rule in reversed(rules):
        out = F.when(rule, reason).otherwise(out)
    return out


def reason_histogram(rows: DataFrame, reason: str = "reason", name: str = "name", shown: int = 40) -> DataFrame:
    """(reason, n, names): counts, and the first names in order. A report: only `shown` names a reason are kept, by rank before they are gathered."""
    n = rows.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))
    first = rows.select(reason, name).distinct().withColumn("_r", F.row_number().over(W.partitionBy(reason).orderBy(name))).where(F.col("_r") <= shown)
    names = first.groupBy(reason).agg(F.sort_array(F.collect_list(name)).alias("names"))
    return n.join(names.withColumnRenamed(reason, "_reason"), F.col(reason).eqNullSafe(F.col("_reason")), "left").drop("_reason")


def spaced_places(places: DataFrame, separation_m: float = 8000.0, quota: dict[str, int] | None = None, cap: int | None = None, group: str = "region") -> DataFrame:
    """Greedy choice by group in order of (forced, namesake, kind_rank, -population, km, name): a place stays if it is
    separation_m from all that stay; forced and namesake ones are exempt, forced ones from the quota a sub-region too."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["forced", "namesake", "kind_rank", "population", "km", "name"], ascending=[False, False, True, False, True, True], kind="stable")
        kept, used = [], {}
        xy = pdf[["lat", "lon"]].to_numpy(float)
        for i, (forced, namesake, sub) in enumerate(zip(pdf.forced, pdf.namesake, pdf["sub"], strict=True)):
            if cap is not None and len(kept) >= cap:
                break
            if not forced and used.get(sub, 0) >= (quota or {}).get(sub, 1 << 30):
                continue
            if not (forced or namesake) and kept and haversine_np(xy[kept], xy[i]).min() < separation_m:
                continue
            kept.append(i)
            used[sub] = used.get(sub, 0) + 1
        return pdf.iloc[kept]

    return places.groupBy(group).applyInPandas(pick, places.schema)


def greedy_survivors(nodes: DataFrame, conflicts: DataFrame, node: str = "id", max_rounds: int = 200) -> DataFrame:
    """Rows that stay when taken in order of id: a row goes if a row that stays before it is in conflict with it.

    conflicts: (a, b) with a before b. Rounds settle what has no open conflict with an earlier row; links of settled
    rows fall away, so a round's work shrinks. Links are written between rounds, never collected.
    """
    open_, gone = conflicts.select("a", "b").distinct(), None
    for _ in range(max_rounds):
        open_ = open_.checkpoint() if open_.sparkSession.sparkContext.getCheckpointDir() else open_
        if open_.isEmpty():
            break
        free = open_.select("a").distinct().join(open_.select(F.col("b").alias("a")).distinct(), "a", "left_anti")  # stays for sure
        lost = open_.join(free, "a").select("b").distinct()
        gone = lost if gone is None else gone.union(lost)
        gone = gone.checkpoint() if gone.sparkSession.sparkContext.getCheckpointDir() else gone
        lost = lost.select(F.col("b").alias("x"))
        open_ = open_.join(lost, F.col("b") == F.col("x"), "left_anti").join(lost, F.col("a") == F.col("x"), "left_anti")
    else:
        raise RuntimeError("greedy_survivors did not settle")
    return nodes if gone is None else nodes.join(gone.withColumnRenamed("b", node).distinct(), node, "left_anti")


def first_of_near(places: DataFrame, within_m: float, size: tuple[float, float], node: str = "id") -> DataFrame:
    """(id): places (id, lat, lon) taken in order of id, without those within within_m of one that stays before them; by cells.

    Of the rows of one place only the first can stay: what it gives way to comes before the others too. So places meet, not copies."""
    from ridgeline.operators.gaps import closest_vertices

    first = places.groupBy("lat", "lon").agg(F.min(node).alias(node)).select(node, F.lit(0).alias("seq"), "lat", "lon")
    near = closest_vertices(first.withColumnRenamed(node, "a"), first.withColumnRenamed(node, "b"), within_m, size).where("a < b").select("a", "b")
    return greedy_survivors(first.select(node), near, node)


# Fixed values of a shape: times the tolerance that a contained line leaves the other, that a junction's tail climbs over
# it, and that a step may fall back by; the share of rising steps in a tail; the share of points that lie near.
STRAY, TAIL, SLACK, RISING, MOSTLY = 3, 4, 0.25, 0.75, 0.6


def profile_shape(near_m: Column, tol: float = 20.0) -> Column:
    """'subsumed', 'junction' or 'unclear' for an array of distances along a line."""

    def shape(d: np.ndarray) -> str:
        n = len(d)
        near = d <= tol
        if n < 4:
            return "unclear"
        if near.all() or d.max() <= STRAY * tol:
            return "subsumed"
        edge = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(int), [0]])))
        if not len(edge):
            return "unclear"
        starts, ends = edge[::2], edge[1::2]
        k = int((ends - starts).argmax())
        a, b = starts[k], ends[k]
        tail = d[b:] if a == 0 else d[:a][::-1] if b == n else None
        if tail is not None and len(tail) >= 3 and (np.diff(tail) >= -SLACK * tol).mean() >= RISING and tail.max() > TAIL * tol:
            return "junction"
        if a > 0 and b < n:
            return "subsumed" if max(d[:a].max(), d[b:].max()) <= TAIL * tol else "unclear"
        return "subsumed" if (b - a) / n >= MOSTLY else "unclear"

    @F.pandas_udf("string")
    def classify(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else shape(np.asarray(r, float)) for r in rows], dtype=object)

    return classify(near_m)


def cover_decision(share: Column, shape: Column, keep_below: float = 0.30, replace_from: float = 0.70) -> Column:
    return F.when(share < keep_below, "keep").when((share >= replace_from) & (shape == "subsumed"), "replace").when(shape == "junction", "keep").otherwise("review")
