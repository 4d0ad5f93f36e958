"""Ids by shard: distinct lists with sizes and offsets, and per-row splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of
from sampleloom.operators.joins import lookup_join
from sampleloom.operators.ordering import HOT_ROWS, positions


def shard_of(fid: ColumnLike, shards: int) -> Column:
    return F.pmod(col_of(fid), F.lit(shards).cast("bigint")).cast("int")


def shard_unique_ids(ids: DataFrame, shards: int) -> DataFrame:
    """Distinct ``(shard, table, fid)`` of rows with ``(table, fid)``."""
    return ids.select("table", "fid").distinct().withColumn("shard", shard_of("fid", shards))


def shard_sizes(unique: DataFrame) -> DataFrame:
    """Distinct ids per shard and table, and per shard."""
    g = unique.groupBy("shard", "table").agg(F.count(F.lit(1)).alias("table_size"))
    return g.withColumn("shard_size", F.sum("table_size").over(Window.partitionBy("shard")))


def shard_offsets(unique: DataFrame, dims: dict[str, int], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Where each id's vector starts when shards, tables and ids are laid out one after the other.

    Ids are numbered inside (shard, table); the starts of those blocks come from a running sum
    over shards × tables rows.
    """
    dim = F.create_map(*[F.lit(x) for kv in dims.items() for x in kv])[F.col("table")]
    before = Window.orderBy("shard", "table").rowsBetween(Window.unboundedPreceding, -1)
    # shards × tables rows: a configuration-sized window
    bases = (unique.groupBy("shard", "table").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_base", F.coalesce(F.sum(F.col("_n") * dim).over(before), F.lit(0)))
             .select(F.struct("shard", "table").alias("_k"), "_base"))
    numbered = positions(unique, ["shard", "table"], [F.col("fid")], "_pos", hot_rows)
    j = lookup_join(numbered.withColumn("_k", F.struct("shard", "table")), bases, "_k")
    return j.select("shard", "table", "fid",
                    (F.col("_base") + (F.col("_pos") - 1) * dim).cast("bigint").alias("offset"))


def split_list(ids: ColumnLike, shards: int, distinct: bool = False) -> Column:
    """Split one row's list by shard: ``ARRAY<STRUCT(shard, ids, positions)>`` with original
    positions, or each shard's distinct ids."""
    v = col_of(ids)

    def one(s: Column) -> Column:
        mine = F.filter(v, lambda f: F.pmod(f, F.lit(shards).cast("bigint")) == s)
        if distinct:
            return F.struct(s.alias("shard"), F.array_distinct(mine).alias("ids"))
        at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(v), F.lit(1)) - 1),
                      lambda i: F.coalesce(F.pmod(F.get(v, i), F.lit(shards).cast("bigint")) == s,
                                           F.lit(False)))
        return F.struct(s.alias("shard"), mine.alias("ids"), at.alias("positions"))

    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), one)


def feature_stat(tables: DataFrame) -> DataFrame:
    """Entries per table."""
    return tables.groupBy("table").agg(F.count(F.lit(1)).alias("entries"))


def row_ids(rows: DataFrame, row_key: str, ids: str) -> DataFrame:
    """``(row, value)`` of every list element."""
    return rows.select(F.col(row_key), F.explode(ids).alias("value"))


def merge_ragged(frames: list[DataFrame], row_key: str, ids: str) -> DataFrame:
    """Stack ragged columns of several frames; rows keep their key, so no splits are rebased."""
    out = frames[0].select(F.lit(0).alias("source"), row_key, ids)
    for i, f in enumerate(frames[1:], 1):
        out = out.unionByName(f.select(F.lit(i).alias("source"), row_key, ids))
    return out
