"""Importance resampling towards a target: documents drawn by how much more their n-grams say of the target than of the corpus.

Each text's words are laid out with their positions, one row a word; lead() over the text's own window adds the words
that follow, for each order of n-gram, and a row keeps the bucket of each n-gram that begins there. That position
table is written once. Grouping it gives the corpus counts of the buckets, and with the target's counts each bucket's
gain, the log ratio of its smoothed shares; joined back, gains are averaged over a document's n-grams. A Gumbel number
from the hash of seed and id goes to the mean, and the documents with the highest sums are a draw without
replacement. Ranks come from the counts of equal scores and the place among them: no task orders all documents.

Texts travel once, to make a row's window local; they are sorted there before words are laid out, so the window's own
sort finds its rows in order. A text is one row of the input and its window one key, so no window is larger than the
longest text. Gains are a table of as many rows as there are buckets (a parameter, at most MOST_BUCKETS) and are
broadcast; scores are whole numbers of bounded range, so their counts are few at any size of corpus.

Cases: null and empty texts have no words, weight 0 and a score but no rank; a null id hashes as an empty string;
rows may repeat, each is drawn for itself, and rows equal in score and id are ranked as they come; an empty corpus
gives an empty table, an empty target counts nothing; long texts are read whole; columns besides id and text are left
out, so their names clash with nothing, and an id column with the name of an output column is an error.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.llm.shared import parts_for, volume, written

#: Fixed value: what a word is, before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Buckets that may be broadcast with their gains.
MOST_BUCKETS = 1 << 20
#: Bytes of text in a partition of the position table.
PART_BYTES = 12 << 20
OUT = ["n_words", "n_features", "weight", "score", "rank"]


def lowered(word: Column) -> Column:
    """A-Z in lower case and nothing else; words of single bytes go the fast way."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def position_table(docs: DataFrame, id_col: str, text_col: str, orders: int, buckets: int) -> DataFrame:
    """(_row, _id, b1 .. bn): for each word of each text the buckets of the n-grams that begin there, null where the text
    ends before; a text without words is one row of nulls."""
    _, size = volume(docs, f"`{text_col}`")
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    local = texts.repartition(parts_for(docs.sparkSession, size, PART_BYTES), "_row").sortWithinPartitions("_row")
    words = local.select("_row", "_id", F.posexplode_outer(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))).alias("_pos", "_w")).withColumn("_w", lowered(F.col("_w")))
    text = W.partitionBy("_row").orderBy("_pos")
    ahead = words.select("_row", "_id", "_w", *(F.lead("_w", k).over(text).alias(f"_w{k}") for k in range(1, orders)))

    def bucket(k: int) -> Column:
        gram = F.concat_ws(" ", "_w", *(f"_w{i}" for i in range(1, k)))
        return F.when(F.col(f"_w{k - 1}" if k > 1 else "_w").isNotNull(), (F.crc32(gram) % buckets).cast("int"))

    return ahead.select("_row", "_id", *(bucket(k).alias(f"b{k}") for k in range(1, orders + 1)))


def bucket_counts(positions: DataFrame, orders: int, name: str) -> DataFrame:
    """(bucket, name) of a position table; counted where the rows are before they travel."""
    each = positions.select(F.explode(F.array(*(f"b{k}" for k in range(1, orders + 1)))).alias("bucket"))
    return each.where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def gain_table(corpus: DataFrame, target: DataFrame, orders: int, buckets: int) -> DataFrame:
    """(bucket, gain) of the buckets that the corpus has: 1000 ln of the target's smoothed share over the corpus's, rounded down."""
    both = written(bucket_counts(corpus, orders, "s").join(bucket_counts(target, orders, "t"), "bucket", "full_outer").fillna(0, ["s", "t"]), "buckets")
    held = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * F.lit(float(held["s"] + buckets))) / ((s + 1) * F.lit(float(held["t"] + buckets)))
    return both.where("s > 0").select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def gumbel(seed: int, id_col: Column) -> Column:
    """1000 times a Gumbel number from the first 32 bits of sha256("<seed>:<id>"), rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", orders: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7) -> DataFrame:
    """(id_col, n_words, n_features, weight, score, rank) of every row; rank is 1, 2, 3 ... of those drawn, else null.

    Of the documents with least_words words or more, percent in 100 (rounded down) are drawn.
    """
    if id_col in OUT:
        raise ValueError(f"the id column has the name of an output column: {id_col}")
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"gains are broadcast: at most {MOST_BUCKETS} buckets")
    corpus = written(position_table(docs, id_col, text_col, orders, buckets), "positions")
    wanted = position_table(target.select(F.lit(0).alias("_id"), F.col(f"`{target_col}`").alias("_text")), "_id", "_text", orders, buckets)
    gains, with_gains = written(gain_table(corpus, wanted, orders, buckets), "gains"), corpus
    for k in range(1, orders + 1):
        with_gains = with_gains.join(F.broadcast(gains.select(F.col("bucket").alias(f"b{k}"), F.col("gain").alias(f"g{k}"))), f"b{k}", "left")
    n = sum((F.count(f"b{k}") for k in range(2, orders + 1)), F.count("b1"))
    total = sum((F.coalesce(F.sum(f"g{k}"), F.lit(0)) for k in range(1, orders + 1)), F.lit(0))
    summed = with_gains.groupBy("_row", "_id").agg(F.count("b1").alias("n_words"), n.alias("n_features"), total.alias("_gain"))
    mean = F.when(F.col("n_features") > 0, F.floor(F.col("_gain") / F.col("n_features"))).otherwise(F.lit(0)).cast("long")
    scored = written(summed.select("_row", "_id", "n_words", "n_features", mean.alias("weight"), (mean + gumbel(seed, F.col("_id"))).alias("score"), (F.col("n_words") >= least_words).alias("_may")), "scored")
    return ranked(scored, percent).select(F.col("_id").alias(id_col), *OUT)


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """scored with rank long: of the rows that may be drawn, the highest scores; ties to the smaller id.

    A score's rows begin behind all that score higher. Scores are whole numbers of bounded range, so the one window
    over all of them has some thousands of rows; the rows themselves meet only with those of their own score.
    """
    higher = W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)
    counts = scored.where("_may").groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("score", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_before"), F.floor(percent * F.sum("_n").over(W.partitionBy()) / 100).alias("_drawn"))
    place = F.col("_before") + F.row_number().over(W.partitionBy("score", "_may").orderBy("_id", "_row"))
    out = scored.join(starts, "score", "left").withColumn("rank", F.when(F.col("_may"), place))
    return out.withColumn("rank", F.when(F.col("rank") <= F.col("_drawn"), F.col("rank")).cast("long"))
