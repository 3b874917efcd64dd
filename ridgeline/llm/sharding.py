"""Two-pass external shuffle into shards, in DataFrame functions alone.

Pass one scatters records into memory-sized buckets: a record's shard is the one whose seeded hash with the
key is largest (rendezvous hashing), its bucket within the shard a second seeded hash. Pass two permutes each
bucket by Fisher-Yates (Spark's shuffle(array, seed), over records put in a fixed order first) and lays the
shard's buckets end to end. No task holds more than a bucket.

The law is `key`: key and shard count alone decide the shard, so one more shard takes records only into itself.

Cases: a null text counts no bytes; a null key hashes as a value of its own; records with equal keys share a
shard and are spread over its buckets by their text; an empty table gives an empty table; other columns pass
through whatever their names, but for those named shard, slot and grown_shard, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.llm.shared import volume

SEED = 42
#: Partitions of pass two at most; one may hold many buckets, which it takes one after another.
MOST_TASKS = 20_000
#: What a record counts for in a bucket besides its text, so that null and short texts fill buckets too.
ROW_BYTES = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the largest seeded hash; ties go to the larger number."""
    best = F.array_max(F.array(*(F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("h"), F.lit(i).alias("s")) for i in range(shards))))
    return best["s"]


def shuffled(docs: DataFrame, shards: int, *, key_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = 4 << 20) -> DataFrame:
    """docs with shard int, slot long (0 up without gaps in each shard) and grown_shard int (with a shard more)."""
    cols = [c for c in docs.columns if c not in ("shard", "slot", "grown_shard")]
    key, text = F.col(f"`{key_col}`"), F.col(f"`{text_col}`")
    n, size = volume(docs, f"`{text_col}`")
    buckets = max(1, -(-(size + ROW_BYTES * n) // (bucket_bytes * shards)))
    content = F.xxhash64(F.lit(seed + 1), key, text)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in cols)).alias("r"), content.alias("h"), shard_of(key, shards, seed).alias("s"), shard_of(key, shards + 1, seed).alias("g"),
        F.pmod(content, F.lit(buckets)).cast("int").alias("b"),
    )
    record = F.struct("h", "g", "r")
    if "map<" in docs.schema.simpleString():  # maps have no order
        in_order = F.array_sort(F.collect_list(record), lambda x, y: F.when(x["h"] < y["h"], -1).when(x["h"] > y["h"], 1).otherwise(0))
    else:
        in_order = F.sort_array(F.collect_list(record))
    # shuffle() draws from a generator a partition, so partitions and the order in them are fixed by the data alone
    dealt = rows.repartition(min(shards * buckets, MOST_TASKS), "s", "b")
    mixed = dealt.groupBy("s", "b").agg(in_order.alias("a")).sortWithinPartitions("s", "b").select("s", "b", F.shuffle("a", F.lit(seed)).alias("a"))
    # the counts by bucket come from a plain aggregate; only they meet in a window, one row a bucket
    before = F.sum("n").over(W.partitionBy("s").orderBy("b").rowsBetween(W.unboundedPreceding, -1))
    starts = rows.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n")).select(F.col("s").alias("s2"), F.col("b").alias("b2"), F.coalesce(before, F.lit(0)).alias("base"))
    out = mixed.join(starts, (F.col("s") == F.col("s2")) & (F.col("b") == F.col("b2"))).select("s", "base", F.posexplode("a").alias("i", "x"))
    return out.select(*(F.col("x.r")[c].alias(c) for c in cols), F.col("s").alias("shard"), (F.col("base") + F.col("i")).cast("long").alias("slot"), F.col("x.g").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """The shuffled records as Parquet, a folder a shard. A file holds whole buckets in slot order; a bucket's slots follow one another."""
    shuffled(docs, shards, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
