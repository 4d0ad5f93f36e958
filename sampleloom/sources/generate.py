"""Repeatable random samples for tests and load runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.functions.base import u01
from sampleloom.functions.fid import make_fid


def generate_samples(spark: SparkSession, rows: int, slots: dict[str, int], dense: dict[str, int] | None = None,
                     actions: int = 5, vocabulary: int = 10000, drop_rate: float = 0.0, max_ids: int = 4,
                     seed: str = "gen", start: int = 1_700_000_000) -> DataFrame:
    """``rows`` samples made from their row number alone: id lists per slot (left empty with
    ``drop_rate``), dense vectors, one action, a label and a time."""
    key = F.concat_ws("|", F.lit(seed), F.col("id"))

    def u(*salt):
        return u01(key, F.concat_ws("/", *[s if not isinstance(s, (str, int)) else F.lit(s) for s in salt]))

    base = spark.range(rows)
    cols = [F.col("id").alias("sample_id"), F.floor(u("uid") * vocabulary).alias("uid"),
            (F.lit(start) + F.col("id")).cast("bigint").alias("req_time"),
            F.array((F.floor(u("action") * actions) + 1).cast("int")).alias("actions"),
            F.array(F.when(u("label") < 0.3, 1.0).otherwise(0.0)).alias("label")]
    for name, slot in slots.items():
        n = F.when(u(name, "drop") < drop_rate, 0).otherwise(F.floor(u(name, "n") * max_ids) + 1).cast("int")
        ids = F.transform(F.sequence(F.lit(1), F.lit(max_ids)),
                          _id_maker(u, name, slot, vocabulary))
        cols.append(F.slice(ids, F.lit(1), n).alias(name))
    for name, dim in (dense or {}).items():
        cols.append(F.transform(F.sequence(F.lit(1), F.lit(dim)), _value_maker(u, name)).alias(name))
    return base.select(*cols)


def _id_maker(u, name: str, slot: int, vocabulary: int):
    return lambda i: make_fid(slot, F.floor(u(name, i.cast("string")) * vocabulary))


def _value_maker(u, name: str):
    return lambda i: u(name, i.cast("string"))
