"""Parquet scans with declared columns, and date-ranged reads."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted physical types per declared type; lists of them are accepted too.
_DECLARED = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "fid_v1": (T.LongType,),
    "fid_v2": (T.LongType,),
    "float": (T.FloatType, T.DoubleType),
    "bytes": (T.StringType, T.BinaryType),
}
# Reserved column names and the sample columns they stand for.
RESERVED = {"__LABEL__": "label", "__LINE_ID__": "line_id", "instance_weight": "instance_weight"}


def check_types(df: DataFrame, columns: Sequence[str], types: Sequence[str]) -> None:
    """Raise unless every column exists with a physical type its declaration allows."""
    if len(columns) != len(types):
        raise ValueError("one declared type per column is needed")
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name, declared in zip(columns, types):
        if declared not in _DECLARED:
            raise ValueError(f"unknown declared type {declared}")
        if name not in fields:
            raise ValueError(f"column {name} not found")
        base = fields[name]
        while isinstance(base, T.ArrayType):
            base = base.elementType
        if not isinstance(base, _DECLARED[declared]):
            raise ValueError(f"column {name} is {fields[name].simpleString()}, declared {declared}")


def scan_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                 types: Sequence[str]) -> DataFrame:
    """Read the named columns only, after checking their declared types. ``__FIELD__`` columns are
    renamed to the LineId field they carry."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    check_types(df, columns, types)
    plain = {c: RESERVED.get(c) or (c.strip("_").lower() if re.fullmatch("__[A-Z_]+__", c) else c) for c in columns}
    return df.select(*[F.col(c).alias(n) for c, n in plain.items()])


def date_range(df: DataFrame, start: str, end: str | None = None, column: str = "dt",
               today: str | None = None) -> DataFrame:
    """Rows of ``start <= dt < end`` on the partition column; the end defaults to today. The
    predicate is on the partition column alone, so only the wanted folders are listed."""
    stop = end or today or datetime.now().strftime("%Y%m%d")
    return df.filter((F.col(column) >= start) & (F.col(column) < stop))


def hourly_range(df: DataFrame, start: tuple[str, int], end: tuple[str, int], date: str = "dt",
                 hour: str = "hr") -> DataFrame:
    """Hourly form of :func:`date_range` over ``dt`` and ``hr`` partitions, end exclusive."""
    (d0, h0), (d1, h1) = start, end
    d, h = F.col(date), F.col(hour).cast("int")
    return df.filter((d >= d0) & (d <= d1) & ((d > d0) | (h >= h0)) & ((d < d1) | (h < h1)))


def _dates(a: str, b: str) -> list[str]:
    fmt, step = {8: ("%Y%m%d", timedelta(days=1)), 10: ("%Y%m%d%H", timedelta(hours=1))}[len(a)]
    at, stop, out = datetime.strptime(a, fmt), datetime.strptime(b, fmt), []
    while at <= stop:
        out.append(at.strftime(fmt))
        at += step
    return out


def expand_patterns(pattern: str) -> list[str]:
    """Paths of a pattern with ``{DATE(a,b)}`` (8 or 10 digits) and ``{INT(a,b)}`` parts, both ends
    inclusive, all combinations in order."""
    parts = re.split(r"(\{(?:DATE|INT)\(\d+,\s*\d+\)\})", pattern)
    choices = []
    for p in parts:
        m = re.fullmatch(r"\{(DATE|INT)\((\d+),\s*(\d+)\)\}", p)
        if not m:
            choices.append([p])
        elif m[1] == "INT":
            choices.append([str(i) for i in range(int(m[2]), int(m[3]) + 1)])
        else:
            if len(m[2]) != len(m[3]) or len(m[2]) not in (8, 10):
                raise ValueError(f"dates of {p} need 8 or 10 digits")
            choices.append(_dates(m[2], m[3]))
    return ["".join(c) for c in product(*choices)]


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths (or globs) that match something, in order; fails when none does."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in sorted(set(paths)):
        path = jvm.org.apache.hadoop.fs.Path(p)
        hits = path.getFileSystem(conf).globStatus(path)
        if hits is not None and len(hits) > 0:
            found.append(p)
    if not found:
        raise FileNotFoundError(f"no file matches {list(paths)[:3]}")
    return found


def shard_files(spark: SparkSession, paths: Sequence[str] | str, shards: int, index: int) -> DataFrame:
    """The rows of every ``shards``-th file of the sorted file list, from ``index`` on: workers share the files, and none
    reads another's. A worker beyond the files gets no rows."""
    if not 0 <= index < shards:
        raise ValueError("index must be in 0 to shards - 1")
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    mine = sorted(df.inputFiles())[index::shards]
    return spark.read.schema(df.schema).parquet(*mine) if mine else df.limit(0)


def read_patterns(spark: SparkSession, patterns: Sequence[str],
                  exclude: Callable[[str], bool] | None = None) -> DataFrame:
    """Read all existing files of the expanded patterns; ``exclude`` drops files by name."""
    paths = existing(spark, [x for p in patterns for x in expand_patterns(p)])
    df = spark.read.parquet(*paths)
    return df if exclude is None else exclude_files(df, exclude)


def exclude_files(df: DataFrame, exclude: Callable[[str], bool], whole_path: bool = False) -> DataFrame:
    """Read only the files of ``df`` whose base name (or whole path) ``exclude`` does not accept; the file list is metadata."""
    drop = [f for f in df.inputFiles() if exclude(f if whole_path else f.rsplit("/", 1)[-1])]
    kept = [f for f in df.inputFiles() if f not in set(drop)]
    if not kept:
        raise FileNotFoundError("every file is excluded")
    return df.sparkSession.read.schema(df.schema).parquet(*kept) if drop else df
