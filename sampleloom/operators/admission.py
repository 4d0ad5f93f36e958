"""Frequency counting of ids and the decision which ids may enter the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleloom.functions.base import lit_map, u01
from sampleloom.functions.fid import slot_of
from sampleloom.operators.joins import HOT_ROWS, lookup_join
from sampleloom.operators.ordering import first_in_key, largest_group
from sampleloom.operators.segments import CHUNK, GROUP, distinct_segments
from sampleloom.session import settled

# Fixed value: a 4-bit counter stops here.
COUNTER_LIMIT = 15


def fid_frequency(ids: DataFrame, cap: int | None = None) -> DataFrame:
    """``(fid, cnt)``; exact, or saturating at ``cap``."""
    n = F.count(F.lit(1))
    return ids.groupBy("fid").agg((F.least(n, F.lit(cap)) if cap else n).alias("cnt"))


def approximate_frequency(ids: DataFrame, eps: float = 0.001, confidence: float = 0.99,
                          seed: int = 7) -> DataFrame:
    """Bounded-memory counts: one row with a count-min sketch of the ids."""
    return ids.agg(F.count_min_sketch("fid", F.lit(eps), F.lit(confidence), F.lit(seed)).alias("sketch"))


def slot_threshold(thresholds: dict[int, int], default: int = 0, version: int = 2,
                   fid: str = "fid") -> Column:
    """Occurrence threshold of the id's slot."""
    if not thresholds:
        return F.lit(default)
    return F.coalesce(lit_map(thresholds, "int", "int")[slot_of(fid, version)], F.lit(default))


def occurrence_admission(ids: DataFrame, order: Sequence[str], thresholds: dict[int, int],
                         default: int = 0, version: int = 2,
                         hot_rows: int = HOT_ROWS, known: DataFrame | None = None) -> DataFrame:
    """Add ``admitted``: the id occurred at least ``threshold`` times before this row, counting the ``(fid, cnt)`` of ``known``.

    Only the threshold-th occurrence of each id matters, so the plan keeps the first few rows per
    id (cut before the shuffle) and compares every row with that one position; no running count
    over a hot id is needed.
    """
    t = slot_threshold(thresholds, default, version)
    most = max([default, *thresholds.values()])
    if most == 0:
        return ids.withColumn("admitted", F.lit(True))
    rows = ids.withColumn("_t", t)
    if known is not None:
        seen = known.select("fid", F.col("cnt").alias("_seen"))
        rows = lookup_join(rows, seen, "fid", hot_rows=hot_rows).withColumn("_t", F.col("_t") - F.coalesce("_seen", F.lit(0))).drop("_seen")
    return _past_cut(rows, ["fid"], order, most, hot_rows).select(*ids.columns, "admitted")


def _past_cut(rows: DataFrame, keys: Sequence[str], order: Sequence[str], most: int, hot_rows: int) -> DataFrame:
    """``rows`` with ``admitted``: ``_t`` rows of the key came before this one. ``most`` is the largest ``_t``."""
    at = F.struct(*order)
    cuts = (first_in_key(rows.filter("_t > 0").select(*keys, "_t", *order), keys, most, [F.col(c) for c in order], "_n")
            .filter("_n = _t").select(F.struct(*keys).alias("_key"), at.alias("_cut")))
    j = lookup_join(rows.withColumn("_key", F.struct(*keys)), cuts, "_key", hot_rows=hot_rows).drop("_key")
    return j.withColumn("admitted", F.when(F.col("_t") <= 0, True).otherwise(F.coalesce(at > F.col("_cut"), F.lit(False))))


def ring_size(capacity: int, split_num: int) -> tuple[int, int]:
    """Distinct ids of a split, and how many splits before the open one still count. One split is kept empty ahead."""
    capacity, split_num = max(300, capacity), max(5, split_num)  # fixed values: the smallest ring
    return capacity // (split_num - 1) - 1, split_num - 2


def ring_splits(ids: DataFrame, order: Sequence[str], distinct: int, state: DataFrame | None = None, chunk: int = CHUNK,
                group: int = GROUP) -> DataFrame:
    """``ids`` with ``split``, the number of the split that was open at each row: it closes with its ``distinct``-th id. The
    ids in the open split of ``state`` are in split 0 already."""
    at = [F.col(c) for c in order]
    if state is None:
        return distinct_segments(ids, at, distinct, "fid", chunk, group, "split")
    open_ = state.filter("age = 0").select("fid", F.lit(0).alias("_new"))
    both = ids.withColumn("_new", F.lit(1)).unionByName(open_, allowMissingColumns=True)
    cut = distinct_segments(both, [F.col("_new"), *at, F.col("fid")], distinct, "fid", chunk, group, "split")
    return cut.filter("_new = 1").drop("_new")


def _split_counts(split: DataFrame, back: int, state: DataFrame | None) -> DataFrame:
    """``(fid, split, cnt, before)``: occurrences in each split, and those that counted before the first of them. A count is carried
    on as long as no more than ``back`` splits lie between; the window sees one row per split of an id."""
    per = split.groupBy("fid", "split").agg(F.count(F.lit(1)).alias("cnt")).withColumn("_had", F.lit(0).cast("bigint"))
    if state is not None:
        had = state.select("fid", (-F.col("age")).cast("bigint").alias("split"), F.lit(0).cast("bigint").alias("cnt"), F.col("cnt").cast("bigint").alias("_had"))
        per = per.unionByName(had).groupBy("fid", "split").agg(F.sum("cnt").alias("cnt"), F.sum("_had").alias("_had"))
    by = Window.partitionBy("fid").orderBy("split")
    lost = F.coalesce((F.col("split") - F.lag("split").over(by) > back).cast("int"), F.lit(0))
    run = Window.partitionBy("fid", "_run").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_lost", lost).withColumn("_run", F.sum("_lost").over(by))
    return per.select("fid", "split", "cnt", (F.coalesce(F.sum(F.col("cnt") + F.col("_had")).over(run), F.lit(0)) + F.col("_had")).alias("before"))


def ring_admission(ids: DataFrame, order: Sequence[str], distinct: int, back: int, thresholds: dict[int, int], default: int = 0, version: int = 2,
                   hot_rows: int = HOT_ROWS, state: DataFrame | None = None, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """Add ``split`` and ``admitted`` by a window that is bounded by distinct ids: a split closes when it holds ``distinct`` ids, an id
    that comes again takes its count along, and an id that is in none of the last ``back`` splits is forgotten.

    A row is admitted if the count before it has reached its slot's threshold. Counts stop at :data:`COUNTER_LIMIT`, so a
    higher threshold admits nothing. Rows of slots without a threshold are admitted and do not enter the ring (null split).
    ``state`` (see :func:`ring_state`) goes on where an earlier run stopped. Up to ``hot_rows`` rows of an id are counted by windows,
    with one shuffle; beyond that, and from a state, counts are joined to the rows."""
    t = slot_threshold(thresholds, default, version)
    never = t > COUNTER_LIMIT
    entering = ids.filter(t > 0)
    counted = ring_splits(entering, order, distinct, state, chunk, group)
    free = ids.filter(t <= 0).select("*", F.lit(None).cast("bigint").alias("split"), F.lit(True).alias("admitted"))
    if state is None and largest_group(entering, ["fid"], hot_rows) <= hot_rows:
        at = [F.col(c) for c in order]
        by, run = Window.partitionBy("fid").orderBy(*at), Window.partitionBy("fid", "_run").orderBy(*at)
        lost = F.coalesce((F.col("split") - F.lag("split").over(by) > back).cast("int"), F.lit(0))
        rows = counted.withColumn("_lost", lost).withColumn("_run", F.sum("_lost").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        out = rows.withColumn("admitted", (F.row_number().over(run) > t) & ~never)
        return out.select(*ids.columns, "split", "admitted").unionByName(free)
    counted = settled(counted)
    before = _split_counts(counted, back, state).select(F.struct("fid", "split").alias("_at"), "before")
    rows = lookup_join(counted.withColumn("_at", F.struct("fid", "split")), before, "_at", hot_rows=hot_rows).drop("_at")
    rows = rows.withColumn("_t", F.when(never, F.lit(COUNTER_LIMIT)).otherwise(t) - F.least("before", F.lit(COUNTER_LIMIT)))
    out = _past_cut(rows, ["fid", "split"], order, COUNTER_LIMIT, hot_rows).withColumn("admitted", F.col("admitted") & ~never)
    return out.select(*ids.columns, "split", "admitted").unionByName(free)


def ring_state(split: DataFrame, distinct: int, back: int, state: DataFrame | None = None) -> DataFrame:
    """``(fid, age, cnt)`` after all rows of :func:`ring_splits` (rows with a null split do not count): the youngest split of each id,
    counted back from the open one, and its count, at most :data:`COUNTER_LIMIT`. Forgotten ids are gone."""
    counts = _split_counts(split.filter("split is not null"), back, state)
    youngest = counts.groupBy("fid").agg(F.max(F.struct("split", (F.col("cnt") + F.col("before")).alias("cnt"))).alias("m"))
    last = counts.groupBy("split").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("split", "n")).alias("l"))
    head = last.select((F.col("l.split") + (F.col("l.n") >= distinct).cast("int")).alias("head"))  # one row
    aged = youngest.join(F.broadcast(head)).select("fid", (F.greatest("head", F.lit(0)) - F.col("m.split")).cast("int").alias("age"), F.least(
        F.col("m.cnt"), F.lit(COUNTER_LIMIT)).cast("int").alias("cnt"))
    return aged.filter(F.col("age") <= back)


def merged_counts(saves: Sequence[DataFrame], cap: int = COUNTER_LIMIT) -> DataFrame:
    """Counts of several saves together, by id: ``(fid, cnt)``, or ``(fid, age, cnt)`` with the youngest split. Sums stop at ``cap``."""
    both = saves[0]
    for s in saves[1:]:
        both = both.unionByName(s)
    n = F.least(F.sum("cnt"), F.lit(cap)).cast(saves[0].schema["cnt"].dataType).alias("cnt")
    return both.groupBy("fid").agg(*([F.min("age").alias("age")] if "age" in both.columns else []), n)


def save_counts(counts: DataFrame, path: str, shards: int | None = None) -> None:
    """Counts or ring state of ids, in ``shards`` files by id."""
    (counts.repartition(shards, "fid") if shards else counts).write.mode("overwrite").parquet(path)


def restore_counts(spark: SparkSession, paths: Sequence[str], cap: int = COUNTER_LIMIT) -> DataFrame:
    return merged_counts([spark.read.parquet(p) for p in paths], cap)


def sliding_admission(ids: DataFrame, time: str, block_seconds: int, blocks: int,
                      threshold: int) -> DataFrame:
    """``(fid, block, cnt, admitted)``: occurrences over the latest ``blocks`` time blocks.

    Counting per (id, block) comes first, so the window below sees one row per block of an id.
    """
    block = F.floor(F.col(time) / F.lit(block_seconds)).cast("bigint")
    per_block = ids.groupBy("fid", block.alias("block")).agg(F.count(F.lit(1)).alias("_c"))
    recent = Window.partitionBy("fid").orderBy("block").rangeBetween(-(blocks - 1), 0)
    return (per_block.withColumn("cnt", F.sum("_c").over(recent))
            .select("fid", "block", "cnt", (F.col("cnt") >= threshold).alias("admitted")))


def probabilistic_admission(counts: DataFrame, known: DataFrame, threshold: int, step: int | Column,
                            equal_probability: bool = False, miss: float = 0.05) -> DataFrame:
    """Add ``admitted`` to ``(fid, cnt)``: ids of the table ``known`` always, new ids with
    probability cnt/threshold, or 1 − (1 − p)^cnt with p = 1 − miss^(1/threshold)."""
    if equal_probability:
        p = 1.0 - miss ** (1.0 / threshold)
        chance = F.lit(1.0) - F.pow(F.lit(1.0 - p), F.col("cnt"))
    else:
        chance = F.col("cnt") / F.lit(float(threshold))
    step = step if isinstance(step, Column) else F.lit(step)
    flags = known.select("fid", F.lit(True).alias("_known")).distinct()
    j = lookup_join(counts, flags, "fid")
    return j.select(*counts.columns,
                    (F.col("_known").isNotNull() | (u01("fid", step) < chance)).alias("admitted"))


def touched_keys(ids: DataFrame, keys: Sequence[str] = ("fid",)) -> DataFrame:
    """Distinct ids of a micro-batch. There is no capacity, so nothing is ever dropped."""
    return ids.select(*keys).distinct()


def touched_set(ids: DataFrame, order: Sequence[str], capacity: int, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """``(fid, dropped)``: what a set of ``capacity`` holds after all rows, in order, and how many ids were cleared on the way (the same on
    each row). A set that holds more than its capacity is cleared before the next row enters, so a round is a segment of
    ``capacity`` + 1 distinct ids; the last round is what is left to steal."""
    cut = distinct_segments(ids.select("fid", *[c for c in order if c != "fid"]), [F.col(c) for c in order], capacity + 1, "fid", chunk, group, "_round")
    rounds = cut.groupBy("_round", "fid").agg(F.lit(1).alias("_one"))
    last = cut.agg(F.max("_round").alias("_last"))  # one row
    return (rounds.join(F.broadcast(last)).filter("_round = _last")
            .select("fid", (F.col("_last") * (capacity + 1)).alias("dropped")))


def counter_weight(ids: DataFrame, threshold: int) -> DataFrame:
    """``(fid, counter, weight)``: capped occurrence counter, started at 1, and its sigmoid
    weight."""
    n = F.least(F.count(F.lit(1)) + 1, F.lit(threshold)).cast("double")
    return (ids.groupBy("fid").agg(n.alias("counter"))
            .withColumn("weight", F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(4.0) - F.lit(0.03) * F.col("counter")))))
