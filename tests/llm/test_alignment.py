import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ridgeline.llm import alignment, queries
from ridgeline.llm.bpe import byte_values
from ridgeline.llm.queries import piece_model, tokenizer_files
from tests.llm.conftest import prose


def libraries():
    a = Tokenizer.from_file(tokenizer_files()[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=piece_model())


def brute(rows):
    """Each row's columns from the libraries' tokens, every pair of overlapping tokens looked at by itself."""
    lib_a, lib_b = libraries()
    shown = byte_values()

    def spans(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at += len(of(i))
        return out

    def bytes_a(i):
        return bytes(shown[c] for c in lib_a.id_to_token(i))

    def bytes_b(i):
        return bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode()

    parts, pairs = [], Counter()
    for key, text in rows:
        raw = b" " + (text or "").encode()
        a, b = lib_a.encode(" " + (text or ""), add_special_tokens=False).ids, lib_b.encode(text or "")
        if not text or b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
            parts.append((key, [], [], [], []))
            continue
        a, b = spans(a, bytes_a), spans(b, bytes_b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        links, j = [], 0
        for i, lo, hi in a:
            while b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        groups, lo = [], 0
        for hi in cuts:
            groups.append(",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi)) if len(raw) < 5000 else groups.append(None)
            lo = hi
        pairs.update(links)
        parts.append((key, a, b, groups, links))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = []
    for key, a, b, groups, links in parts:
        sha = None if groups and groups[0] is None else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((key, len(a), len(b), len(groups), len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links), sha))
    return Counter(out)


def got(df, long=()):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, None if r.doc_id in long else r.groups_sha256) for r in df.collect())


def run(docs, keep=("doc_id",)):
    a, ranks = tokenizer_files()
    return alignment.aligned(docs, list(keep), a, piece_model(), ranks)


def test_every_row_is_brute_force(docs, rows):
    more = [(i, t) for i, t in rows]
    assert got(run(docs), long={40}) == brute(more)


def test_odd_texts(spark):
    rng = random.Random(8)
    rows = [(1, "a▁b"), (2, "<|endoftext|> and </s> <0x0A>"), (3, "中文字符 😀 é"), (4, "\n\n\t x"), (5, "   "), (6, " "), (7, "▁"), (8, "naïve Straße 1234567 www.a.org/x?y=z"), (9, None), (None, "a b"), (None, "a b")]
    rows += [(100 + k, "".join(rng.choice("aeinstß ▁.,\n²'12中") for _ in range(rng.randint(1, 90))).replace("▁", "" if k % 3 else "▁")) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(run(docs)) == brute(rows)


@pytest.fixture(scope="module")
def plain_rows():
    rng = random.Random(9)
    return [(i, prose(rng, rng.randint(1, 50)) + " the the the" * (i % 3)) for i in range(150)]


def test_small_blocks_slices_and_batches(spark, plain_rows, monkeypatch):
    docs = spark.createDataFrame(plain_rows, "doc_id long, text string").repartition(5)
    want = brute(plain_rows)
    assert got(run(docs)) == want
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    monkeypatch.setattr(alignment, "CELL", 50)
    monkeypatch.setattr(alignment, "BINS", 3)
    assert got(run(docs)) == want


def test_streams_settle_in_any_batches(plain_rows, monkeypatch):
    """Counts carried over from batch to batch, shares summed early."""
    import pyarrow as pa

    heads = [(0, 0, None, None, [3, 5], [9, 4]), (0, 0, 100, [0, 1, 1], [3, 3, 5], [1, 2, 1]), (0, 0, 200, [0], [5], [7]), (2, 0, None, None, [5], [8]), (2, 0, 100, [1], [5], [3])]
    kinds = {"b": pa.int32(), "slice": pa.int32(), "row": pa.int64(), "docs": pa.list_(pa.int32()), "a": pa.list_(pa.int32()), "n": pa.list_(pa.int64())}
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in heads], t) for k, t in enumerate(kinds.values())], names=list(kinds))
    for each in (1, 2, 5):
        for few in (1, 2, 100):
            monkeypatch.setattr(alignment, "AT_A_TIME", few)
            monkeypatch.setattr(alignment, "HELD", few)
            out = Counter(), Counter()
            for x in alignment.shares(batch.slice(k, each) for k in range(0, 5, each)):
                for r in x.to_pylist():
                    out[0][r["row"]] += r["n_best"]
                    out[1][r["row"]] += r["count_sum"]
            assert dict(out[0]) == {100: 1, 101: 2 + 3, 200: 0} and dict(out[1]) == {100: 9, 101: 18 + 4 + 24, 200: 28}


def test_empty_table_and_names(spark, docs, empty):
    assert run(empty).count() == 0
    kept = run(docs.select("doc_id", "text", F.col("kept").alias("slice"), F.col("spans").alias("pairs")), ["doc_id", "slice", "pairs"])
    assert kept.columns[:3] == ["doc_id", "slice", "pairs"] and {(r.slice, r.pairs) for r in kept.collect()} == {("yes", 7)}
    for name in ("row", "n_best", "docs"):
        with pytest.raises(ValueError):
            run(docs.withColumnRenamed("bucket", name), ["doc_id", name])


def test_query(spark, tmp_path, docs, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_postings_alignment(spark, str(tmp_path))
    assert sorted(out.columns) == sorted("doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split())
    assert {t for c, t in out.dtypes if c != "groups_sha256"} == {"bigint"} and out.count() == len(rows)


def test_bytes_are_compared_for_a_block_at_once(monkeypatch):
    """(op11 in the check of round 3) Texts that a side changes have no tokens, wherever in a block they stand, and no text is joined by itself."""
    a, ranks = tokenizer_files()
    of = alignment.Sides(a, ranks, piece_model())
    changed = {"x" * 40: 0, "y" * 40: 1}  # a side gives other bytes: more of them, or as many
    plain, encode = of.a.plain, of.b.encode
    monkeypatch.setattr(of.a, "plain", lambda t: plain(t + "more" if t[1:] in changed and not changed[t[1:]] else t))
    monkeypatch.setattr(of.b, "encode", lambda t: encode(t.replace("y", "z") if t in changed else t))
    texts = ["x" * 40, "a plain text", "", "y" * 40, "é ü 😀 \x00", "y" * 40, "another one", "x" * 40]
    joined = []

    class Watched(list):
        def __getitem__(self, i):
            joined.append(i)
            return super().__getitem__(i)

    of.a_bytes, of.b_bytes = Watched(of.a_bytes), Watched(of.b_bytes)
    (n_a, ids_a), (n_b, ids_b) = of.ids(texts)
    assert not joined
    assert [bool(n) for n in n_a] == [bool(n) for n in n_b] == [t not in changed and t != "" for t in texts]
    lo_a = lo_b = 0
    for t, x, y in zip(texts, n_a.tolist(), n_b.tolist(), strict=True):
        raw = b"".join(of.a_bytes[i] for i in ids_a[lo_a : lo_a + x].tolist()), b"".join(of.b_bytes[i] for i in ids_b[lo_b : lo_b + y].tolist())
        assert not x or raw == (b" " + t.encode(),) * 2
        lo_a, lo_b = lo_a + x, lo_b + y
    assert (lo_a, lo_b) == (len(ids_a), len(ids_b))
    assert [len(v) for pair in of.ids([]) for v in pair] == [0] * 4 and alignment.Block(of, ["", "x" * 40]).n_links.tolist() == [0, 0]
