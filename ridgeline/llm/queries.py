"""The queries opN_<name> over the driver's tables: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import alignment, bpe, grulm, lattice, licenses, packing, pieces, quality, resample, sharding, simhash, suffix, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels and places of whole texts. Null and empty texts have none; rows may repeat."""
    return licenses.scanned(_table(spark, sf_dir, "documents"), ["doc_id"]).drop("matches")


def op2_linear_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that a 50-byte string of a smaller doc_id covers, removed. Null and empty texts lose nothing."""
    out = suffix.deduplicated(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of whole texts, the base rule and the trees' verdict. Null and empty texts fail the base rule."""
    docs = _table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fitted(docs, _table(spark, sf_dir, "labels")), ["doc_id"])


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and the smallest doc_id that links of 4 bits reach. Texts without words have fingerprint zero."""
    out = simhash.grouped(_table(spark, sf_dir, "documents"), "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids. Null and empty texts are one piece with the end id."""
    return packing.packed(_table(spark, sf_dir, "documents"), *tokenizer_files()).drop("ids")


def op6_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of whole texts, as digests. Null texts are empty."""
    return bpe.encoded(_table(spark, sf_dir, "documents"), ["doc_id"], *tokenizer_files()).drop("ids", "id_bytes")


def op7_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by the law of keys. Null texts have size 8."""
    out = sharding.shuffled(_table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", sharding.size_of(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_lattice_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a cosine of 0.95 or more, counted, and their components. Null, zero and non-finite vectors stand alone."""
    out = lattice.grouped(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op9_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and recurrent log10 likelihoods of whole texts. Null and empty texts are the end alone."""
    return grulm.scored(_table(spark, sf_dir, "documents"))


def op10_fuzzy_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole texts, learned from labels outside the held-out third. Empty texts score as texts without hits."""
    docs = _table(spark, sf_dir, "documents")
    out = toxicity.scored(docs, toxicity.fitted(docs, _table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", (~toxicity.trained_on(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_postings_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of byte-level and piece tokens, with corpus counts of pairs. Null, empty and changed texts have no tokens."""
    a, ranks = tokenizer_files()
    return alignment.aligned(_table(spark, sf_dir, "documents"), ["doc_id"], a, piece_model(), ranks)


def op12_gain_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the benchmark by gains of one and two words. Null texts weigh nothing."""
    return resample.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_words")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_prefix_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of whole texts, as digests. Null texts are empty."""
    return pieces.encoded(_table(spark, sf_dir, "documents"), ["doc_id"], piece_model()).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_license_templates, op2_linear_suffix_dedup, op3_boosted_quality, op4_simhash_groups, op5_hilbert_packing, op6_chunk_reuse_bpe, op7_two_pass_shuffle, op8_lattice_links, op9_gated_lm, op10_fuzzy_lexicon, op11_postings_alignment, op12_gain_resampling, op13_prefix_table_pieces)}

#: op8: all pairs, which DuckDB can afford on a small table. op12: CRC-32 as steps over a text's bytes. The other operators' hashes, models and tokenizers are beyond SQL: tests/llm works them out again.
ORACLE_SQL: dict[str, str] = {
    "op8_lattice_links": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l ON l.a = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id""",
    "op12_gain_resampling": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wanted AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM docs),
wanted_grams AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM wanted),
steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
names AS (SELECT g FROM grams UNION SELECT g FROM wanted_grams),
codes AS (SELECT g, list_transform(range(1, octet_length(encode(g)) + 1), lambda i: ('0x' || substr(hex(encode(g)), 2 * i - 1, 2))::BIGINT) AS c FROM names),
buckets AS (SELECT g, xor(list_reduce(list_prepend(4294967295, c), lambda a, x: xor(a >> 8, t[xor(a % 256, x) + 1])), 4294967295) % 10000 AS b FROM codes, steps),
s AS (SELECT b, count(*) AS n FROM grams JOIN buckets USING (g) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM wanted_grams JOIN buckets USING (g) GROUP BY b),
gains AS (SELECT s.b, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE) / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t ON s.b = t.b),
sums AS (SELECT doc_id, count(*) AS n, sum(gain) AS gain FROM grams JOIN buckets USING (g) JOIN gains USING (b) GROUP BY doc_id),
weights AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(gain / n), 0)::BIGINT AS weight, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM docs LEFT JOIN sums USING (doc_id)),
scores AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weights),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM scores LEFT JOIN places USING (doc_id)""",
}
