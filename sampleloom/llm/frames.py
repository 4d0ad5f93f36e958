"""Small helpers on DataFrames: columns kept beside new ones, bounded samples, groups of documents, shared tables."""

from __future__ import annotations

import ctypes
import pickle
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.session import checkpoint_dir


_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None
if _LIBC is not None and not hasattr(_LIBC, "malloc_trim"):
    _LIBC = None
#: Bytes of text in a group of documents that a Python worker takes at once.
GROUP_BYTES = 6 << 20
#: Bytes of rows that one call works on, so that a worker holds little beside the batch it got.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def add_columns(df: DataFrame, read: list[str], ddl: str, make: Callable[[pa.RecordBatch], dict], keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) of ``df`` and the columns of ``ddl``, which ``make`` derives from pieces of Arrow
    batches: whole rows, about ``PIECE_BYTES`` of them. A kept column with the name of a new one is replaced."""
    new = schema_of(ddl)
    kept = [c for c in (keep if keep is not None else df.columns) if c not in new.names]
    out = T.StructType([df.schema[c] for c in kept] + list(new.fields))
    need = [*kept, *[c for c in read if c not in kept]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for whole in batches for piece in _pieces(whole)):
            made = make(b)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(made[f.name], _arrow(f.dataType)) for f in new],
                                             names=out.names)
        release()

    return df.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, out)


def release() -> None:
    """Gives freed memory back to the system: a Python worker lives on after its task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def light(f: Callable) -> Callable:
    """A group function that gives back its memory when it is done."""
    def run(*tables: pa.Table) -> pa.Table:
        out = f(*tables)
        del tables
        release()
        return out
    return (lambda a: run(a)) if f.__code__.co_argcount == 1 else (lambda a, b: run(a, b))


def _pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, b.num_rows * PIECE_BYTES // max(1, b.nbytes))
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def _arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
            T.StringType: pa.string(), T.BinaryType: pa.binary(), T.FloatType: pa.float32()}[type(t)]


def batch(**cols: tuple) -> pa.RecordBatch:
    """Record batch of (values, Arrow type) pairs."""
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols.values()], names=list(cols))


def fold_of(key: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold of a row."""
    return F.pmod(F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")), F.lit(n))


def smallest(df: DataFrame, by: str, n: int) -> DataFrame:
    """A bounded sample: the ``n`` rows with the smallest hash of ``by``."""
    return df.orderBy(F.xxhash64(by), by).limit(n)


def in_one_task(df: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes | None:
    """A model fitted in one executor task on a bounded ``df``; None without rows."""
    schema = schema_of("model binary")

    def run(t: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([fit(t)], pa.binary())})

    rows = df.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, schema).collect()
    return bytes(rows[0]["model"]) if rows else None


def total_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def group_count(nbytes: int, size: int = GROUP_BYTES, least: int = 64, even: int = 10_000) -> int:
    """How many groups of about ``size`` bytes; at least 64, so that small inputs use all cores too. Beyond ``even`` groups the
    number and the size of groups grow alike, as each group sends a row to each shard."""
    n = -(-nbytes // size)
    return max(least, n if n <= even else int((even * n) ** 0.5))


def grouped(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows with a group number ``gid`` from the hash of ``key``. Grouping the result by ``gid`` twice in one query
    moves the rows once: the second use reads the same shuffle files."""
    return df.withColumn("gid", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def pack(**arrays: object) -> bytes:
    """Numpy arrays and plain values as one compressed blob."""
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(blob: bytes) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written to the shared folder: made once, smaller than a checkpoint, and of a size that Spark knows."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
