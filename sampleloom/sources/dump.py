"""Dumps: metrics, training features, item vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_ROWS_PER_FILE = 1_000_000


def metric_dump(metrics: DataFrame, base: str, model: str, day: str | Column, mode: str = "append") -> None:
    """Metric rows as JSON lines under ``base/model=…/dt=…``, at most 10^6 rows per file."""
    dt = day if isinstance(day, Column) else F.lit(day)
    (metrics.withColumn("model", F.lit(model)).withColumn("dt", dt).write.mode(mode)
     .option("maxRecordsPerFile", METRIC_ROWS_PER_FILE).partitionBy("model", "dt").json(base))


def feature_dump(samples: DataFrame, columns: Sequence[str], path: str, rows_per_file: int = 0,
                 mode: str = "errorifexists") -> None:
    w = samples.select(*columns).write.mode(mode)
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).parquet(path)


def item_vectors(items: DataFrame, item: str, bias: str, vector: str, table: str = "item_vector",
                 ts: int = 0) -> DataFrame:
    """Item id, bias and vector as embedding-table rows: the bias leads the vector."""
    num = F.concat(F.array(F.col(bias).cast("double")), F.col(vector).cast("array<double>"))
    return items.select(F.lit(table).alias("table"), F.col(item).cast("bigint").alias("fid"), num.alias("num"),
                        F.lit(None).cast("struct<none:double>").alias("opt"), F.lit(ts).cast("bigint").alias("last_update_ts"))


def item_vector_dump(items: DataFrame, item: str, bias: str, vector: str, path: str, mode: str = "append",
                     **kw) -> None:
    item_vectors(items, item, bias, vector, **kw).drop("opt").write.mode(mode).partitionBy("table").parquet(path)
