import hashlib
import random

import pytest

import corpus_pipeline as P
from ridgeline.llm import queries
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_near_copies import brute
from tests.llm.test_text_operators import brute_repeats

COLUMNS = [c.split()[0].strip("`") for c in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(5)
    texts = {i: prose(rng, 120) for i in range(300)}
    for i in range(0, 300, 6):
        texts[i] += " blorgus " + prose(rng, 5)
    shared = prose(rng, 60)
    for i in (1, 7, 13):
        texts[i] += "\n" + shared
    texts[301], texts[302] = texts[2], texts[2] + " ."
    texts[303], texts[304] = "too short", None
    folder = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.1, "k", 1, 2, "b") for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), texts, shared


def test_stages_take_effect(spark, tables):
    folder, texts, shared = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = P.written(out, name)
        seen.append({r.doc_id: r.text for r in docs.collect()})
    toxic, poor, copies, repeats = seen
    assert not any(i % 6 == 0 for i in toxic if i < 300) and {1, 301, 303, 304} <= set(toxic)
    assert 303 not in poor and 304 not in poor and {1, 2, 3, 301, 302} <= set(poor)
    assert 2 in copies and 301 not in copies and {1, 3, 7} <= set(copies)
    assert set(copies) == set(brute(list(poor.items())).values())
    cut = {k: sha for k, _, _, _, sha in brute_repeats(list(copies.items()))}
    assert {k: hashlib.sha256(t.encode()).hexdigest() for k, t in repeats.items()} == cut
    assert shared in repeats[1] and shared not in repeats[7] and shared not in repeats[13]
    assert P.STAGES[-1][1](spark, docs, folder).groupBy("sequence_id").sum("length").count() > 3


def test_run_and_queries(spark, tables):
    folder, _, _ = tables
    out = P.run(spark, folder)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted(f"op{k}" for k in range(1, 14))
