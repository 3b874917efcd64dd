"""What the operators share: the cluster's shared folder, batches of bounded size, shipping of code."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of text that a worker holds as numpy arrays at a time.
PIECE_BYTES = 1 << 20
#: Workers are reused from task to task: what arrays leave behind goes back to the system, not to a worker's heap.
_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(8 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system", "OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1"}


def on_workers(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (the same install path on every node)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    for name, value in _MEMORY.items():
        env.setdefault(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ridgeline-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here and no step above runs twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ridgeline-{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def volume(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(rows, bytes of text); one cheap scan of two numbers a task."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def schema_of(docs: DataFrame, keep: list[str], rest: str) -> StructType:
    """The columns of keep as in docs, then those of rest; a name in both is an error (boxed() keeps such columns apart)."""
    added = StructType.fromDDL(rest).fields
    if both := {f.name for f in added}.intersection(keep):
        raise ValueError(f"columns to keep have names of the output: {sorted(both)}")
    return StructType([StructField(c, docs.schema[c].dataType, True) for c in keep] + added)


def pa_type(docs: DataFrame, column: str) -> pa.DataType:
    """The Arrow type in which Python workers see a column."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def boxed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, text): all other columns in one, so that no name of theirs can clash with an operator's."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    return docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in rest)).alias("_row"), id_col, text_col)


def unboxed(df: DataFrame, like: DataFrame, changed: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of `like` from a boxed frame; changed gives some of them anew."""
    own = {id_col: F.col(id_col), text_col: F.col(text_col)} | (changed or {})
    return df.select(*((own[c] if c in own else F.col("_row").getField(c)).alias(c) for c in like.columns))


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """Partitions so that each holds about `each` bytes (or rows), and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-size // each), 1)


def flat(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    binary = pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)
    arr = arr.cast(pa.large_binary() if binary else pa.large_utf8())
    if arr.null_count:
        arr = pc.fill_null(arr, b"" if binary else "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    flat_bytes = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return flat_bytes, off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = flat(batch.column(text_col))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def map_texts(docs: DataFrame, cols: list, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], text_col: str = "text", limit: int = PIECE_BYTES) -> DataFrame:
    """mapInArrow over pieces. make() runs once a task and returns the function from a piece to the output's columns."""
    on_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for piece in pieces(batches, text_col, limit):
            out = f(piece)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(*dict.fromkeys(cols)).mapInArrow(run, schema)
