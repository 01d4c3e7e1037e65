"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
MIX_A, MIX_B = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Only a local session, as in tests, gets one of its own."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="quire-shared-")


#: Share of the driver's most heap from which a written table is followed by a collection.
HEAP_SHARE = 0.4


def collect_garbage(spark: SparkSession) -> None:
    """Collect the driver's garbage, unless its heap is small. Plans, shuffle files and broadcasts of steps that are over go
    only with that, and a chain of many small steps lets the heap grow to its limit by what is garbage."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() >= HEAP_SHARE * runtime.maxMemory():
        runtime.gc()


def stash(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    collect_garbage(spark)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables and broadcasts of one run of an operator, tables in the shared folder; close() deletes those that are
    not kept, and all broadcasts."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at, self.kept = spark, f"{shared_dir(spark)}/run-{uuid.uuid4().hex}", set()
        self.sent: list = []

    def broadcast(self, value):
        self.sent.append(self.spark.sparkContext.broadcast(value))
        return self.sent[-1]

    def table(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = f"{self.at}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        if keep:
            self.kept.add(path)
        collect_garbage(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        while self.sent:
            self.sent.pop().destroy()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.at)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        kept = {p.rsplit("/", 1)[-1] for p in self.kept}
        for x in fs.listStatus(path) if fs.exists(path) else []:
            if x.getPath().getName() not in kept:
                fs.delete(x.getPath(), True)


def small_batches(spark: SparkSession, rows: int) -> None:
    """Lower the session's rows of an Arrow batch to `rows` (never raise them): rows hold whole texts, and lazy results are
    run after the operator returns, so that the setting cannot be put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * MIX_B
        return h ^ (h >> U64(27))


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 16 << 20):
    """Slices of a batch whose column holds about most_bytes at most (or one row)."""
    n = batch.num_rows
    if not n:
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    start = 0
    while start < n:
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def ascii_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words `[^\\x20\\x09-\\x0D]+` of each text (null: none): offsets, and the flat words."""
    text = pc.fill_null(as_array(text), "")
    trimmed = pc.ascii_trim_whitespace(text)
    words = pc.ascii_split_whitespace(trimmed)
    offsets = np.asarray(words.offsets, dtype=np.int64)
    flat = words.values
    empty = np.asarray(pc.equal(pc.binary_length(trimmed), 0))
    if empty.any():  # an empty string splits into one empty word
        keep = np.ones(len(flat), dtype=bool)
        keep[offsets[:-1][empty & (np.diff(offsets) > 0)]] = False
        counts = np.diff(offsets)
        counts[empty] = 0
        flat = flat.filter(pa.array(keep))
        offsets = np.concatenate([[0], np.cumsum(counts)])
    return offsets, flat


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash for each word, the same in every process."""
    if not len(flat):
        return np.zeros(0, dtype=U64)
    coded = pc.dictionary_encode(flat)
    digest = xxhash.xxh3_64_intdigest
    table_ = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), dtype=U64, count=len(coded.dictionary))
    return table_[np.asarray(coded.indices)]


def shingle_sets(text: pa.Array, k: int = 5) -> list[np.ndarray]:
    """The sorted set of hashed k-word shingles of each text: A-Z lowered; a text of fewer words is one shingle; without words none."""
    offsets, flat = ascii_words(pc.ascii_lower(pc.fill_null(as_array(text), "")))
    h = word_hashes(flat)
    out = []
    with np.errstate(over="ignore"):
        m = max(0, len(h) - k + 1)
        g = np.full(m, U64(k)) * MIX_A
        for i in range(k):
            g = mix((g + h[i : i + m]) * MIX_A)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            n = b - a
            if n >= k:
                out.append(np.unique(g[a : b - k + 1]))
            elif n:
                x = np.array([n], dtype=U64) * MIX_A
                for i in range(a, b):
                    x = mix((x + h[i]) * MIX_A)
                out.append(x)
            else:
                out.append(np.zeros(0, dtype=U64))
    return out
