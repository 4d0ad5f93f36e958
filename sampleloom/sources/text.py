"""Text sources and sinks: CSV samples, ratings, prediction lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of

CSV_SCHEMA = "mov BIGINT, uid BIGINT, label FLOAT"


def csv_samples(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines ``mov,uid,label``; a broken line fails the read. See :func:`csv_lines` for files that hold some."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(CSV_SCHEMA).option("mode", "FAILFAST").csv(path)


def csv_lines(spark: SparkSession, path: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of the good lines, and the broken lines (``line``) for a quarantine: each line is in one of the two."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path)
    parsed = lines.select("value", F.from_csv("value", f"{CSV_SCHEMA}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"}).alias("r"))
    good = parsed.filter("r._broken is null and length(trim(value)) > 0")
    return good.select("r.mov", "r.uid", "r.label"), parsed.filter("r._broken is not null").select(F.col("value").alias("line"))


def hashed_id(text: ColumnLike, portable: bool = False) -> Column:
    """Non-negative id of a text: 63 bits of xxhash64, or 60 bits of md5 for other engines."""
    t = col_of(text).cast("string")
    if portable:
        return F.conv(F.substring(F.md5(t.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.xxhash64(t).bitwiseAND(F.lit((1 << 63) - 1).cast("bigint"))


def ingest_ratings(df: DataFrame, title: str, user: str, rating: str, portable: bool = False) -> DataFrame:
    return df.select(hashed_id(title, portable).alias("mov"), hashed_id(user, portable).alias("uid"),
                     F.col(rating).cast("double").alias("label"))


def prediction_lines(df: DataFrame, fields: Sequence[str], delimiter: str = "\t") -> DataFrame:
    """One text line per row: fields and predictions joined; lists inside a field use commas."""
    types = dict(df.dtypes)
    cols = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",") if types[c].startswith("array")
            else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    return df.select(F.concat_ws(delimiter, *cols).alias("value"))


def prediction_dump(df: DataFrame, fields: Sequence[str], path: str, delimiter: str = "\t",
                    mode: str = "errorifexists") -> None:
    prediction_lines(df, fields, delimiter).write.mode(mode).text(path)
