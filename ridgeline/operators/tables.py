"""Snapshots, merges and constraints over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before, after, state): added, removed, changed or same."""
    b, a = before.select(key, F.col(value).alias("before"), F.lit(True).alias("_b")), after.select(F.col(key).alias("_k"), F.col(value).alias("after"), F.lit(True).alias("_a"))
    both = b.join(a, F.col(key) == F.col("_k"), "full_outer")
    state = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("changed")
    return both.select(F.coalesce(key, "_k").alias(key), "before", "after", state.alias("state"))


def replaced(old: DataFrame, new: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """old without the keys of gone, and new's rows; a key that both have afterwards is an error at run time."""
    stay = old.join(gone.select(key).distinct(), key, "left_anti")
    both = stay.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    from pyspark.sql import Window as W

    clash = F.count(F.lit(1)).over(W.partitionBy(key)) > 1
    return both.withColumn("_c", F.when(clash, F.raise_error(F.concat(F.lit("id on both sides: "), F.col(key).cast("string")))).otherwise(F.lit(0))).where("_c is null or _c = 0").drop("_new", "_c")


def carried_over(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """new with fields that it leaves null taken from old."""
    o = old.select(F.col(key).alias("_k"), *(F.col(f).alias(f"_o_{f}") for f in fields))
    both = new.join(o, F.col(key) == F.col("_k"), "left")
    return both.select(*(F.coalesce(c, f"_o_{c}").alias(c) if c in fields else F.col(c) for c in new.columns))


def tag_union(rows: DataFrame, key: str, tags: str) -> DataFrame:
    """Rows of two listings by key: all their comma-separated tags, sorted, once each."""
    each = rows.select(key, F.explode(F.split(F.col(tags), ",")).alias("t")).select(key, F.trim("t").alias("t")).where("t <> ''").distinct()
    return each.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("t")), ",").alias(tags))


Violations = DataFrame


def _found(rows: DataFrame, rule: str, entity: Column, detail: Column) -> Violations:
    return rows.select(F.lit(rule).alias("rule"), entity.cast("string").alias("entity"), detail.cast("string").alias("detail"))


def duplicates(rows: DataFrame, key: str, rule: str) -> Violations:
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _found(n, rule, F.col(key), F.col("n"))


def orphans(rows: DataFrame, ref: str, parents: DataFrame, parent_key: str, rule: str) -> Violations:
    """References without a parent, once each, with how many rows have it."""
    lost = rows.where(F.col(ref).isNotNull()).join(parents.select(F.col(parent_key).alias(ref)).distinct(), ref, "left_anti")
    n = lost.groupBy(ref).agg(F.count(F.lit(1)).alias("n"))
    return _found(n, rule, F.col(ref), F.col("n"))


def outside(rows: DataFrame, key: str, ok: Column, shown: Column, rule: str) -> Violations:
    """Rows for which ok is not true."""
    return _found(rows.where(~F.coalesce(ok, F.lit(False))), rule, F.col(key), shown)


def count_mismatch(declared: DataFrame, key: str, count: str, rows: DataFrame, ref: str, rule: str) -> Violations:
    n = rows.groupBy(F.col(ref).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    both = declared.join(n, F.col(key) == F.col("_k"), "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return _found(both.where(F.col("_n") != F.col(count)), rule, F.col(key), F.concat_ws("/", F.col(count).cast("string"), F.col("_n").cast("string")))


def all_violations(parts: list[Violations]) -> Violations:
    return reduce(DataFrame.unionAll, parts)


def concatenation_errors(line_points: DataFrame, segment_points: DataFrame, line: str = "line") -> DataFrame:
    """Points (line, seq, lat, lon) that the line and its joined segments don't share exactly, on either side."""
    cols = [line, "seq", "lat", "lon"]
    a, b = line_points.select(*cols), segment_points.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("line")).union(b.exceptAll(a).withColumn("side", F.lit("segments")))


def falling(rows: DataFrame, key: str, order: str, value: str, rule: str) -> Violations:
    """Rows whose value is below the one before it along the key."""
    from pyspark.sql import Window as W

    before = F.lag(value).over(W.partitionBy(key).orderBy(order))
    bad = rows.withColumn("_before", before).where(F.col(value) < F.col("_before"))
    return _found(bad.groupBy(key).agg(F.count(F.lit(1)).alias("n")), rule, F.col(key), F.col("n"))


def not_one_of(rows: DataFrame, key: str, column: str, values: list, rule: str) -> Violations:
    return _found(rows.where(~F.coalesce(F.col(column).isin(values), F.lit(False))), rule, F.col(key), F.coalesce(F.col(column).cast("string"), F.lit("null")))


def misnamed(rows: DataFrame, key: str, pattern: str, rule: str) -> Violations:
    return _found(rows.where(~F.coalesce(F.col(key).rlike(pattern), F.lit(False))), rule, F.col(key), F.lit(pattern))


def wrong_extents(rows: DataFrame, key: str, declared: DataFrame, rule: str, places: int = 5) -> Violations:
    """Keys whose declared box (min_lat, min_lon, max_lat, max_lon) is not that of their points."""
    sides = {f"{n}_{c}": f(c) for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")}
    real = rows.groupBy(key).agg(*(F.round(v, places).alias(f"r_{k}") for k, v in sides.items()))
    both = real.join(declared.withColumnRenamed(key, "_k"), F.col(key) == F.col("_k"))
    wrong = [k for k in sides]
    differ = F.concat_ws(",", *(F.when(~F.round(k, places).eqNullSafe(F.col(f"r_{k}")), k) for k in wrong))
    return _found(both.withColumn("_d", differ).where("_d <> ''"), rule, F.col(key), F.col("_d"))


def stale_hashes(manifest: DataFrame, files: DataFrame, rule: str) -> Violations:
    """Keys whose hash (key, hash) differs between manifest and files, or that one side lacks."""
    d = snapshot_diff(manifest, files, "key", "hash").where("state <> 'same'")
    return _found(d, rule, F.col("key"), F.col("state"))
