"""Packing documents into training sequences along a Hilbert curve.

A document's token counts are hashed to VECTOR signed sums, projected to DIMS numbers and quantised; the Hilbert
key of that cell, then a hash of the id, orders all documents, so neighbours on the curve have like words.
The order is cut into bins at quantiles of a hashed sample of keys; bins are packed end to end, and a document
that crosses a sequence's end continues in the next one. Every sequence but the last is full.

Documents with equal vectors (a large group of copies) share a key; the id's hash spreads them over bins like
any others. A task sorts its bin (Spark's sort, which spills) and packs it as a stream, so it holds a batch, not a
bin. There are at most MOST_BINS bins, whatever the data; the driver holds a bound and a token count for each and a
sample of keys, `per_bin` a bin at most.

Cases: null and empty texts are one piece with the end id; rows may repeat, each is packed; a null id is an id
like any other; ties in place go by the ids' checksum, then the id; other columns are left out, so none clashes;
an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ridgeline.llm.bpe import encoder
from ridgeline.llm.shared import map_texts, on_workers, parts_for, written

LENGTH = 2048
END_ID = 1
VECTOR, DIMS, BITS = 64, 3, 10
MOST_BINS = 1 << 14


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of cells (n, dims), each below 2**bits; Skilling's transform (2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, 0) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


class Projector:
    """Hashed vectors and their keys; the same tables in every worker."""

    def __init__(self, vocabulary: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.slot = rng.integers(0, VECTOR, vocabulary)
        self.sign = rng.choice([-1.0, 1.0], vocabulary)
        self.project = rng.normal(size=(VECTOR, DIMS))

    def vector(self, ids: np.ndarray) -> np.ndarray:
        v = np.bincount(self.slot[ids], self.sign[ids], VECTOR)
        v = np.sign(v) * np.sqrt(np.abs(v))
        norm = np.sqrt((v * v).sum())
        return v / norm if norm else v

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        y = vectors @ self.project
        cells = np.clip(((np.tanh(y) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        return hilbert(cells, BITS)


def tokenised(docs: DataFrame, id_col: str, tokenizer_path: str, ranks_path: str | None, text_col: str = "text") -> DataFrame:
    """(id_col, place long, n_tokens long, ids binary): place orders by the Hilbert key, then a hash of the id. n_tokens has the end id."""

    def make():
        enc = encoder(tokenizer_path, ranks_path)
        projector = Projector(max(enc.tokenizer.get_vocab_size(), END_ID + 1))

        def f(piece: pa.RecordBatch) -> dict:
            ids = [enc.encode(t or "") for t in piece.column(text_col).to_pylist()]
            vectors = np.array([projector.vector(np.frombuffer(b, enc.dtype)) for b in ids])
            return {id_col: piece.column(id_col), "curve": projector.keys(vectors), "n_tokens": np.array([len(b) // enc.dtype.itemsize + 1 for b in ids], np.int64), "ids": ids}

        return f

    out = map_texts(docs, [id_col, text_col], f"`{id_col}` {dict(docs.dtypes)[id_col]}, curve long, n_tokens long, ids binary", make, text_col)
    place = F.shiftleft("curve", 32).bitwiseOR(F.xxhash64(F.lit(11), id_col).bitwiseAND(F.lit(0xFFFFFFFF)))
    return out.select(id_col, place.alias("place"), "n_tokens", "ids")


def packed(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, *, id_col: str = "doc_id", length: int = LENGTH, bin_tokens: int = 1 << 21, per_bin: int = 64, text_col: str = "text") -> DataFrame:
    """A row a piece: id_col, start, length, ids (binary, little-endian 32-bit), ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    on_workers(spark)
    table = written(tokenised(docs, id_col, tokenizer_path, ranks_path, text_col), "tokens")
    width = encoder(tokenizer_path, ranks_path).dtype.itemsize
    rows, total = table.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    bins = min(parts_for(spark, total or 0, bin_tokens), MOST_BINS)
    every = max(1, rows // (bins * per_bin))
    sample = table.where(F.rand(5) * every < 1).select("place").toArrow().column("place")
    bounds = np.unique(np.quantile(np.sort(np.array(sample)), np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(sample) else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def bin_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), "right").astype(np.int32))

    sums = table.select(bin_of("place").alias("bin"), "n_tokens").groupBy("bin").agg(F.sum("n_tokens").alias("n")).collect()
    size = np.zeros(len(bounds) + 1, np.int64)
    for r in sums:
        size[r["bin"]] = r["n"]
    base = np.concatenate([[0], np.cumsum(size)])

    def pack(batches):
        now, at = None, 0
        for batch in batches:
            names = ("row", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            out: dict[str, list] = {k: [] for k in names}
            for row, (b, ids) in enumerate(zip(batch.column("bin").to_pylist(), batch.column("ids"), strict=True)):
                if b != now:
                    now, at = b, int(base[b])
                full = np.append(np.frombuffer(ids.as_py(), f"<u{width}").astype("<u4"), np.uint32(END_ID)).tobytes()
                total, lo = len(full) // 4, 0
                while lo < total:
                    hi = min(total, lo + length - at % length)
                    part = full[4 * lo : 4 * hi]
                    for k, v in zip(names, (row, lo, hi - lo, part, zlib.crc32(part), total, at // length, at % length), strict=True):
                        out[k].append(v)
                    at += hi - lo
                    lo = hi
            columns = {"id": batch.column("id").take(pa.array(out.pop("row"), pa.int64()))}
            yield pa.RecordBatch.from_pydict(columns | {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()})

    schema = StructType([StructField("id", docs.schema[id_col].dataType)] + StructType.fromDDL("start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long").fields)
    dealt = table.select(F.col(f"`{id_col}`").alias("id"), "place", "n_tokens", "ids", bin_of("place").alias("bin")).repartition(bins, "bin")
    in_order = dealt.sortWithinPartitions("bin", "place", F.crc32("ids"), "n_tokens", "id")
    return in_order.select("id", "ids", "bin").mapInArrow(pack, schema).withColumnRenamed("id", id_col)
