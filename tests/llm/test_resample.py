import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ridgeline.llm import queries, resample
from tests.llm.test_text_operators import low

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, target, orders=2, buckets=10_000, least=20, percent=25, seed=7):
    """(id, n_words, n_features, weight, score, rank) of rows, worked out document by document."""
    def grams(t):
        w = WORD.findall(low(t))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, orders + 1) for i in range(len(w) - k + 1)]

    texts = [(i, *grams(t)) for i, t in rows]
    s, t = Counter(b for _, _, g in texts for b in g), Counter(b for x in target for b in grams(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in s}
    out = []
    for i, n, g in texts:
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    for k, r in enumerate(may[: percent * len(may) // 100], 1):
        r[5] = k
    return Counter(map(tuple, out))


def got(df):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank) for r in df.collect())


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("The river and the stone été",), (None,), ("",), ("Light of the GARDEN",)], "text string")


@pytest.mark.parametrize("options", [{}, {"orders": 3, "buckets": 97, "percent": 60, "least": 1}, {"orders": 1, "percent": 100, "seed": 3}])
def test_draw_is_brute_force(docs, rows, target, options):
    own = {{"least": "least_words"}.get(k, k): v for k, v in options.items()}
    assert got(resample.resampled(docs, target, **own)) == brute(rows, [r.text for r in target.collect()], **options)


def test_equal_rows_are_drawn_each(spark, target):
    rows = [(7, "river stone " * 15)] * 9 + [(None, "paper silver " * 12)] * 4 + [(9, "ÉTÉ É a1 " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = resample.resampled(docs, target, percent=70)
    assert got(out) == brute(rows, [r.text for r in target.collect()], percent=70)
    assert sorted(r.rank for r in out.where("rank is not null").collect()) == list(range(1, 10))


def test_empty_tables_and_names(spark, docs, empty, target):
    assert resample.resampled(empty, target).count() == 0
    nothing = target.where("text = 'none such'")
    few = docs.where("doc_id < 12")
    assert got(resample.resampled(few, nothing)) == brute([(r.doc_id, r.text) for r in few.collect()], [])
    with pytest.raises(ValueError):
        resample.resampled(docs.withColumnRenamed("bucket", "rank"), target, id_col="rank")
    with pytest.raises(ValueError):
        resample.resampled(docs, target, buckets=1 << 21)
    clash = docs.select(F.col("doc_id"), F.col("text"), F.lit(1).alias("_row"), F.lit("x").alias("b1"), F.lit(2).alias("score"))
    assert got(resample.resampled(clash, target)) == got(resample.resampled(docs, target))


def test_no_python_and_one_copy_of_the_texts(spark, docs, target):
    plan = resample.position_table(docs, "doc_id", "text", 2, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan and "Python" not in plan


def test_query_is_its_sql(spark, tmp_path, rows):
    duckdb = pytest.importorskip("duckdb")
    known = {i: t for i, t in rows if i is not None}
    spark.createDataFrame(list(known.items()), "doc_id long, text string").repartition(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the river of light"), (2, "Paper, silver; été")], "item_id long, text string").repartition(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    want = con.sql(queries.ORACLE_SQL["op12_gain_resampling"]).df()[cols].astype(float).fillna(-1).values.tolist()
    out = queries.op12_gain_resampling(spark, str(tmp_path))
    assert out.columns == cols and out.dtypes == [(c, "bigint") for c in cols]
    assert sorted(out.toPandas().astype(float).fillna(-1).values.tolist()) == sorted(want)
