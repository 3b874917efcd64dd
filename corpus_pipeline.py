"""From raw documents to packed training sequences, in five stages, each an operator of ridgeline.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import nearcopies, packing, quality, suffix, toxicity
from ridgeline.llm.queries import tokenizer_files
from ridgeline.llm.shared import boxed, unboxed, written

#: A document goes from this toxicity score on.
TOXIC_FROM = 0.7
BOX = ["_row", "doc_id", "text"]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold.

    Null and empty texts score as texts without hits and stay; long texts are read whole; repeated rows all stay or
    all go; a score of exactly TOXIC_FROM goes; an empty table, or one without labels, passes as it is. Columns
    travel boxed, so their names clash with none of the operator's.
    """
    model = toxicity.fitted(docs, _labels(spark, sf_dir))
    return unboxed(toxicity.scored(boxed(docs), model, BOX).where(F.col("score") < TOXIC_FROM), docs)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the trees keep.

    Null, empty and short texts (fewer than 50 words) fail the base rule and go; long texts are read whole; repeated
    rows share a verdict; without labels the base rule alone decides; an empty table stays empty. Columns travel
    boxed.
    """
    trees = quality.fitted(docs, _labels(spark, sf_dir))
    return unboxed(quality.judged(boxed(docs), trees, BOX).where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8 or more) the document with the smallest id.

    SimHash fingerprints, compared bit-sliced, choose the pairs that the shingles decide. Rows with one id are one document: those with equal texts become one row, others stay together. A row without an
    id is in no group and stays. Texts without words are one group. An empty table stays empty. Extra columns are
    not touched, whatever their names.
    """
    groups = nearcopies.grouped(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id")
    first = written(groups.where("doc_id = component").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).select(F.col("doc_id").alias("_kept"), "_n"), "kept")
    once, often = first.where("_n = 1"), first.where("_n > 1")
    out = docs.join(once, docs["doc_id"] == once["_kept"], "left_semi").union(docs.where("doc_id is null"))
    if often.isEmpty():
        return out
    return out.union(docs.join(often, docs["doc_id"] == often["_kept"], "left_semi").dropDuplicates(["doc_id", "text"]))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has too; n_chars is that of what is left.

    Null texts stay null, empty ones empty; rows with one id don't cut each other; long texts are cut whole; an empty
    table stays empty. Columns travel boxed.
    """
    out = suffix.deduplicated(boxed(docs), BOX, as_text=True)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("kept_text"))
    n_chars = F.when(F.col("text").isNull(), F.col("_row").getField("n_chars")).otherwise(F.length("kept_text")).cast(dict(docs.dtypes).get("n_chars", "long")) if "n_chars" in docs.columns else None
    return unboxed(out, docs, {"text": text} | ({"n_chars": n_chars} if n_chars is not None else {}))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    Null and empty texts are one piece of the end id; repeated rows are packed each; a long text goes on in the next
    sequence; an empty table gives no piece. Other columns of docs are left out.
    """
    return packing.packed(docs, *tokenizer_files()).drop("ids")


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_copies", drop_near_copies), ("repeats", cut_repeats), ("packing", pack)]

#: Learned models, suffix arrays and tokenizers are beyond SQL; tests/llm holds near copies and repeats against
#: brute force stage by stage, and the verdicts of the other stages' operators against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
