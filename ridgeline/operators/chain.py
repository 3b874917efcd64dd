"""Chains of lines: where one can go over into the next, and what a chain adds up to."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def junction_candidates(distances: DataFrame, max_gap_m: float = 150.0, apart_m: float = 150.0, cap: int = 8, pair: str = "pair", seq: str = "seq") -> DataFrame:
    """(pair, seq, along_m, gap_m, rank, fallback) from distances (pair, seq, along_m, gap_m): local minima of the gap within
    max_gap_m, the smallest first, apart_m from those taken; without any the single closest place. cap is a feature: the shown choices."""
    w = W.partitionBy(pair).orderBy(seq)
    low = distances.withColumn("_low", (F.col("gap_m") <= F.coalesce(F.lag("gap_m").over(w), F.col("gap_m"))) & (F.col("gap_m") <= F.coalesce(F.lead("gap_m").over(w), F.col("gap_m"))))
    nearest = distances.groupBy(pair).agg(F.min(F.struct("gap_m", seq, "along_m")).alias("b")).select(pair, "b.*")
    minima = low.where(F.col("_low") & (F.col("gap_m") <= max_gap_m)).select(pair, seq, "along_m", "gap_m")

    if cap == 1:  # the smallest alone needs no spacing
        best = minima.groupBy(pair).agg(F.min(F.struct("gap_m", seq, "along_m")).alias("b")).select(pair, "b.*")
        lone = nearest.join(best.select(pair), pair, "left_anti")
        mark = lambda df, fallback: df.select(pair, seq, "along_m", "gap_m", F.lit(1).alias("rank"), F.lit(fallback).alias("fallback"))
        return mark(best, False).unionByName(mark(lone, True))

    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["gap_m", seq], kind="stable")
        kept: list[int] = []
        at = pdf.along_m.to_numpy()
        for i in range(len(pdf)):
            if len(kept) < cap and all(abs(at[i] - at[k]) >= apart_m for k in kept):
                kept.append(i)
        out = pdf.iloc[kept].copy()
        out["rank"] = range(1, len(kept) + 1)
        return out

    kinds = dict(distances.dtypes)
    got = minima.groupBy(pair).applyInPandas(spread, f"{pair} {kinds[pair]}, {seq} {kinds[seq]}, along_m double, gap_m double, rank int")
    lone = nearest.join(got.select(pair).distinct(), pair, "left_anti")
    return got.withColumn("fallback", F.lit(False)).unionByName(lone.select(pair, seq, "along_m", "gap_m", F.lit(1).alias("rank"), F.lit(True).alias("fallback")))


def resolve(chain: list[dict], lines: dict[str, dict], far_m: float = 150.0) -> list[dict]:
    """The stretch of each element of a chain that is ridden, direction first.

    chain: {id, reversed, entry, exit, off}; entry and exit are km places of the junctions chosen on the element (or
    None), gap_m theirs to the next. An entry holds wherever something lies ahead of it; an exit only if it lies ahead
    of the entry. A junction wider than far_m is off unless switched on. What does not hold is None, with the reason.
    """
    out = []
    for c in chain:
        km = lines[c["id"]]["km"]
        ahead = (lambda a, b: b > a) if not c["reversed"] else (lambda a, b: b < a)
        start, end = (km, 0.0) if c["reversed"] else (0.0, km)
        reason = None
        entry, exit_ = c.get("entry"), c.get("exit")
        off = c.get("off")
        if off or off is None and (c.get("gap_m") or 0) > far_m:
            exit_, reason = None, "off" if off else "far"
        if entry is not None and ahead(entry, end):
            start = entry
        elif entry is not None:
            reason = "next"
        if exit_ is not None and ahead(start, exit_):
            end = exit_
        elif exit_ is not None:
            reason = "exit"
        out.append({"id": c["id"], "from": start, "to": end, "km": abs(end - start), "clipped": (start, end) != ((km, 0.0) if c["reversed"] else (0.0, km)), "reason": reason})
    return out


def chain_totals(elements: DataFrame, lines: DataFrame, profiles: DataFrame, chain: str = "chain") -> DataFrame:
    """(chain, km, up, down): published figures for whole elements, those of the profile for clipped ones.

    elements: chain, seq, id, from_km, to_km (from_km above to_km is ridden backwards), clipped. A profile step counts by the share of it that is ridden.
    """
    w = W.partitionBy("id").orderBy("k")
    steps = profiles.select(F.col("id").alias("_id"), F.lag("km").over(w).alias("k0"), F.col("km").alias("k1"), (F.col("ele") - F.lag("ele").over(w)).alias("rise")).where("k0 is not null")
    lo, hi = F.least("from_km", "to_km"), F.greatest("from_km", "to_km")
    cut = elements.where("clipped").join(steps, (F.col("id") == F.col("_id")), "left").withColumn("part", F.greatest(F.lit(0.0), F.least(hi, F.col("k1")) - F.greatest(lo, F.col("k0"))) / (F.col("k1") - F.col("k0")))
    turned = F.when(F.col("from_km") > F.col("to_km"), -F.col("rise")).otherwise(F.col("rise")) * F.col("part")
    partial = cut.groupBy(chain, "seq").agg(F.first(hi - lo).alias("km"), F.sum(F.when(turned > 0, turned).otherwise(0.0)).alias("up"), F.sum(F.when(turned < 0, -turned).otherwise(0.0)).alias("down"))
    back = F.col("from_km") > F.col("to_km")
    whole = elements.where("not clipped").join(lines.select(F.col("id").alias("_id"), "len", F.col("up").alias("_u"), F.col("down").alias("_d")), F.col("id") == F.col("_id"))
    whole = whole.select(chain, "seq", F.col("len").alias("km"), F.when(back, F.col("_d")).otherwise(F.col("_u")).cast("double").alias("up"), F.when(back, F.col("_u")).otherwise(F.col("_d")).cast("double").alias("down"))
    return whole.unionByName(partial).groupBy(chain).agg(*(F.sum(c).alias(c) for c in ("km", "up", "down")))


def aligned(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence, the earliest pairs first."""
    n, m = len(left), len(right)
    size = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            size[i][j] = size[i + 1][j + 1] + 1 if left[i] == right[j] else max(size[i + 1][j], size[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if left[i] == right[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif size[i + 1][j] >= size[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def match_scores(truth: DataFrame, found: DataFrame, case: str = "case") -> DataFrame:
    """(case, found, direction_ok, total): sequences (case, seq, id, reversed) aligned by LCS, equal neighbours first made one."""

    def sequence(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable")
        return pdf[pdf.id != pdf.id.shift()]

    def score(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = sequence(a), sequence(b)
        pairs = aligned(a.id.tolist(), b.id.tolist())
        ok = sum(bool(a.reversed.iloc[i]) == bool(b.reversed.iloc[j]) for i, j in pairs)
        return pd.DataFrame({case: [key[0]], "found": [len(pairs)], "direction_ok": [ok], "total": [len(a)]})

    return truth.groupBy(case).cogroup(found.groupBy(case)).applyInPandas(score, f"{case} {dict(truth.dtypes)[case]}, found int, direction_ok int, total int")
