"""Running totals and positions inside a key, safe when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleloom.session import settled

# A key with more rows than this is no longer numbered inside a single task.
HOT_ROWS = 1_000_000


# Largest rank limit that Spark applies before the shuffle by default.
GROUP_LIMIT = 1000
# Rows of a just-hot key a size check wants to see; fewer are enough to tell it from a small one.
SEEN_ROWS = 200


def sampling(df: DataFrame, limit: int) -> tuple[DataFrame, float]:
    """``df`` thinned so that a key of ``limit`` rows keeps about :data:`SEEN_ROWS`, and the share
    kept. Only for choosing between plans that give the same rows."""
    share = min(1.0, SEEN_ROWS / max(1, limit))
    return (df.sample(share, seed=17) if share < 1.0 else df), share


def largest_group(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> int:
    """Estimated row count of the biggest key, exact enough to compare with ``limit``; reads the key
    columns only."""
    thin, share = sampling(df.select(*keys) if keys else df.select(), limit)
    counts = thin.groupBy(*keys).count() if keys else thin.agg(F.count(F.lit(1)).alias("count"))
    return round((counts.agg(F.max("count")).first()[0] or 0) / share)


def together(df: DataFrame, key: str) -> DataFrame:
    """The rows of a key in one task. The number of partitions is given, because adaptive execution would join narrow ones that
    grow wide in the same task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), key)


def together_sorted(df: DataFrame, key: str) -> DataFrame:
    """As :func:`together`, the rows of a key one after the other. Narrow rows brought so before broadcast joins make them wide need
    no sort afterwards."""
    return together(df, key).sortWithinPartitions(key)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
            totals: dict[str, Column], hot_rows: int = HOT_ROWS,
            largest: int | None = None) -> DataFrame:
    """Add inclusive running sums of ``totals`` inside ``keys`` along ``order`` (a total order).

    While every key is small this is one window. Otherwise rows are range-partitioned by key and
    order, so a big key spreads over many partitions; sums are taken inside each (key, partition)
    and shifted by the sum of the earlier partitions of the key, of which there are few. Pass
    ``largest`` if the size of the biggest key is already known.
    """
    keys = list(keys)
    if (largest_group(df, keys, hot_rows) if largest is None else largest) <= hot_rows:
        w = (Window.partitionBy(*keys).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.select("*", *[F.sum(c).over(w).alias(n) for n, c in totals.items()])

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = df.select("*", *[c.alias(f"_t_{n}") for n, c in totals.items()])
    ranged = settled(src.repartitionByRange(parts, *keys, *order)
                     .withColumn("_part", F.spark_partition_id()))
    inside = (Window.partitionBy(*keys, "_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = (Window.partitionBy(*keys).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (ranged.groupBy(*keys, "_part")
               .agg(*[F.sum(f"_t_{n}").alias(f"_s_{n}") for n in totals])
               .select(*keys, "_part",
                       *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}")
                         for n in totals]))
    local = ranged.select("*", *[F.sum(f"_t_{n}").over(inside).alias(n) for n in totals])
    cond = [local[k].eqNullSafe(offsets[k]) for k in [*keys, "_part"]]
    joined = local.join(offsets, cond, "left")
    return joined.select(*[local[c] for c in df.columns],
                         *[(F.col(n) + F.col(f"_o_{n}")).alias(n) for n in totals])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              name: str = "position", hot_rows: int = HOT_ROWS,
              largest: int | None = None) -> DataFrame:
    """1-based position of each row inside ``keys`` along ``order``."""
    return running(df, keys, order, {name: F.lit(1).cast("bigint")}, hot_rows, largest)


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> tuple[DataFrame, int]:
    """``df``, cut from its lineage, with the 1-based position of each row along ``order`` (a total order), and the row count. Rows move
    once: they lie sorted in ranges, and a range adds the rows of the earlier ones, of which there is one number each."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = F.col("_at")  # partition and place in it
    rows = settled(ranged.withColumn("_at", F.monotonically_increasing_id()))
    per = rows.groupBy(F.shiftright(at, 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_part").collect()
    begins, total = [], 0
    for r in per:
        begins.append((r["_part"], total))
        total += r["_n"]
    first = df.sparkSession.createDataFrame(begins, "_part bigint, _first bigint")  # one row per partition
    joined = rows.withColumn("_part", F.shiftright(at, 33)).join(F.broadcast(first), "_part")
    place = F.col("_first") + at.bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return joined.select(*df.columns, place.alias(name)), total


def first_in_key(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column],
                 name: str = "position") -> DataFrame:
    """The first ``n`` rows of each key with their position. The rank limit is applied before the
    shuffle as well, so a hot key sends at most ``n`` rows per input partition; Spark does so up to
    :data:`GROUP_LIMIT`, and a larger ``n`` takes the skew-safe numbering."""
    if n > GROUP_LIMIT:
        return positions(df, keys, order, name).filter(F.col(name) <= n)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def with_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column],
                hot_rows: int = HOT_ROWS, largest: int | None = None) -> DataFrame:
    """Add per-key aggregates to every row: a window while keys are small, else an aggregation
    with partial sums that is joined back."""
    from sampleloom.operators.joins import lookup_join

    if (largest_group(df, keys, hot_rows) if largest is None else largest) <= hot_rows:
        w = Window.partitionBy(*keys)
        return df.select("*", *[c.over(w).alias(n) for n, c in totals.items()])
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    sums = df.groupBy(key.alias("_k")).agg(*[c.alias(n) for n, c in totals.items()])
    return lookup_join(df.withColumn("_k", key), sums, "_k", hot_rows=hot_rows).select(
        *df.columns, *totals)
