"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Bytes of text that one chunk (one Python call) holds at most, on average.
CHUNK_BYTES = 8 << 20

_shipped: dict[str, tempfile.TemporaryDirectory] = {}
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


_caches: dict[str, object] = {}
_owner = ""


def claim(owner: str, cache=None) -> None:
    """In a worker: drop what other operators keep there, for workers outlive stages.

    ``cache`` (anything with ``clear``) is what ``owner`` keeps itself.
    """
    global _owner
    if cache is not None:
        _caches[owner] = cache
    if owner != _owner:
        for name, other in _caches.items():
            if name != owner:
                other.clear()
        gc.collect()
        _owner = owner
        with contextlib.suppress(OSError, AttributeError):  # glibc only: large arrays go back when they are freed
            ctypes.CDLL(None).mallopt(-3, 1 << 20)
        give_back()


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def prepare(spark: SparkSession, rows: int = 1000, mb: int = 4) -> None:
    """Bound what one Arrow batch holds, by rows and by bytes (texts can be long), and let workers import the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(":") or context.applicationId in _shipped:
        return
    package = __name__.partition(".")[0]
    scratch = tempfile.TemporaryDirectory()  # the driver's, removed at exit: executors get copies from the driver
    with zipfile.ZipFile(f"{scratch.name}/{package}.zip", "w") as z:
        for f in (root / package).rglob("*.py"):
            z.write(f, f.relative_to(root))
    context.addPyFile(f"{scratch.name}/{package}.zip")
    _shipped[context.applicationId] = scratch


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lapsewise-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: str | Column) -> Column:
    """The text's UTF-8 bytes; a null text is an empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks_for(docs: DataFrame, text: str, per_chunk: int = CHUNK_BYTES) -> int:
    """Number of chunks that hold ``per_chunk`` bytes of text each, at least one per shuffle partition."""
    prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-total // per_chunk))


def in_chunks(docs: DataFrame, key: Column, n: int) -> DataFrame:
    """``docs`` with a ``__chunk`` number, all rows of a chunk in one partition."""
    return docs.withColumn("__chunk", F.pmod(key, F.lit(n)).cast("int")).repartition(n, "__chunk")


def batches(fields: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(fields[f.name], f.type) for f in schema], schema=schema)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of each ordered pair of 64-bit values (multiply and xor-shift rounds)."""
    x = a * _C[0] + np.uint64(1)
    x ^= x >> np.uint64(31)
    x = (x + b) * _C[1]
    x ^= x >> np.uint64(29)
    x *= _C[2]
    x ^= x >> np.uint64(32)
    return x


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive entries of ``h``, by doubling."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level, size = h, 1
    while size * 2 <= width:
        level = mix(level[: len(level) - size], level[size:])
        size *= 2
    return level[:n] if size == width else mix(level[:n], level[width - size: width - size + n])


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each 64-bit hash, rising with the hash."""
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)

