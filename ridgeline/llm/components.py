"""Connected components of links, by alternating star contraction (Kiveris et al., 2014).

Nothing is collected but two sums a round. Each round's links are a table in the shared folder. A node with
a large part of all links meets them in a plain join of two tables, which Spark can split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.shared import written


def _toward_min(links: DataFrame) -> DataFrame:
    """links (u, v): each with the smallest v of its u, or u itself, as m."""
    least = written(links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "least")
    return links.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _clean(links: DataFrame) -> DataFrame:
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of links (u long, v long): component is the smallest node that links reach.

    Null ends and links of a node with itself count as no link. An empty table gives an empty table.
    """
    now = written(_clean(links.select(F.col("u").cast("long"), F.col("v").cast("long")).dropna()), "links")
    state = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _clean(_toward_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = written(large, "large")
        small = _toward_min(large)
        now = written(_clean(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))), "links")
        was, state = state, tuple(now.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
        if state == was or state[0] == 0:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
