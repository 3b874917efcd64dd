"""The faceted query layer: filters, counts, groups, search, sort, all one pass and one small aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.text import folded, natural_key


def category(loop: Column, uphill: Column) -> Column:
    """Exactly one switch governs a row: loop before uphill before downhill."""
    return F.when(F.coalesce(loop, F.lit(False)), "loop").when(F.coalesce(uphill, F.lit(False)), "uphill").otherwise("downhill")


def passes(region: Column, diff: Column, kind: Column, name: Column, *, regions: list[str], diffs: list[str], kinds: list[str], search: str = "", builder: bool = False) -> Column:
    """Active sub-region, difficulty and category, and the search text; loops are hidden in builder mode."""
    ok = region.isin(regions) & diff.isin(diffs) & kind.isin(kinds) & found(name, search)
    return F.coalesce(ok & (kind != "loop") if builder else ok, F.lit(False))


def found(name: Column, search: str) -> Column:
    """Without case and accents."""
    return F.lit(True) if not search else F.contains(folded(name), folded(F.lit(search)))


def counts(rows: DataFrame, shown: Column, kind: str = "kind") -> DataFrame:
    """(kind, shown, hidden, total)."""
    return rows.groupBy(kind).agg(F.count_if(shown).alias("shown"), F.count_if(~shown).alias("hidden"), F.count(F.lit(1)).alias("total"))


def two_levels(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Headings with counts: a row a pair and a row an outer group (inner null, level 1)."""
    return rows.rollup(outer, inner).agg(F.count(F.lit(1)).alias("n"), F.grouping(inner).alias("level")).where(F.grouping(outer) == 0)


def sort_key(by: str) -> list[Column]:
    """Columns to order by: difficulty, name (numbers by value), length up, up and down by height first."""
    order = F.array_position(F.array(*map(F.lit, ("gruen", "blau", "rot", "schwarz"))), F.col("diff"))
    return {"difficulty": [order, natural_key(F.col("name"))], "name": [natural_key(F.col("name"))], "length": [F.col("len")], "up": [F.col("up").desc()], "down": [F.col("down").desc()]}[by] + [F.col("id")]


def hidden_by_solo(lifts: DataFrame, segments: DataFrame, solo_loop: str | None, solo_lift: str | None) -> DataFrame:
    """lifts with hidden: under a solo only the soloed lift and those that the soloed loop rides stay."""
    if solo_loop is None and solo_lift is None:
        return lifts.withColumn("hidden", F.lit(False))
    ridden = segments.where((F.col("loop_id") == F.lit(solo_loop)) & F.col("lift_id").isNotNull()).select(F.col("lift_id").alias("_l")).distinct()
    both = lifts.join(ridden, F.col("id") == F.col("_l"), "left")
    return both.withColumn("hidden", F.col("_l").isNull() & ~F.coalesce(F.col("id") == F.lit(solo_lift), F.lit(False))).drop("_l")


def active_groups(chosen: list[str], at_most: int = 3) -> list[str]:
    """The active set holds the last `at_most` choices."""
    return list(dict.fromkeys(chosen))[-at_most:]


def versioned_url(key: Column, hash_: Column) -> Column:
    """A region file's address with its hash; a key without one is an error."""
    return F.when(hash_.isNull(), F.raise_error(F.concat(F.lit("unknown region: "), key))).otherwise(F.concat(F.lit("regions/"), key, F.lit(".json?v="), hash_))
