"""Negative generation from per-channel item pools.

Time is the order ``(req_time, sample_id)``. A pool is a queue: an item that is not in it enters at the end, and beyond the
capacity the oldest leaves, to enter again when it is seen again. At a row the pool holds what came up to and including
that row. Entries are numbered per channel, so the pool at a moment is the last ``capacity`` numbers up to then.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleloom.functions import labels as L
from sampleloom.functions.base import u01, u32
from sampleloom.operators.joins import lookup_join
from sampleloom.operators.ordering import HOT_ROWS, largest_group, positions, running, with_totals
from sampleloom.session import settled

# A full channel with more rows than this is read by many tasks, that many rows in each.
CHUNK_ROWS = 1 << 15
ONE_POOL = 3  # fixed value: the channel that stands for "all rows share one pool"


@dataclass(frozen=True)
class NegativeConfig:
    neg_num: int
    item_features: tuple[str, ...] = ()
    per_channel: bool = False
    channel: str = "channel"
    item: str = "item_id"
    start_num: int = 500
    max_item_num: int = 100000
    positive_label: float = 1.0
    negative_label: float = -1.0
    negative_action: int | None = None
    positive_actions: tuple[int, ...] = ()
    label_index: int = 0
    action_priority: tuple[int, ...] = ()
    throw_origin: bool = False
    throw_origin_neg: bool = False
    cache_only_pos: bool = True
    cache_negative_actions: tuple[int, ...] = ()
    real_neg_instance_weight: float = 1.0
    sampled_neg_instance_weight: float = -1.0
    unbias_sampled_neg: bool = True
    origin_neg_in_pool_proba: float = 1.0
    decay: float = 1.0
    easy_hard_ratio: float = 0.0

    def __post_init__(self) -> None:
        if self.label_index < 0:
            raise ValueError("label_index must not be negative")
        if set(self.positive_actions) & set(self.cache_negative_actions):
            raise ValueError("positive and cached negative actions overlap")
        if len(set(self.action_priority)) != len(self.action_priority):
            raise ValueError("action priority has repeats")


def is_positive(cfg: NegativeConfig) -> Column:
    """By the highest-priority action if positive actions are named, else by the label."""
    if cfg.positive_actions:
        hit = L.most_prior_action("actions", cfg.action_priority).isin(list(cfg.positive_actions))
    else:
        hit = F.get("label", F.lit(cfg.label_index)) == cfg.positive_label
    return F.coalesce(hit, F.lit(False))


def is_cached(cfg: NegativeConfig, positive: Column) -> Column:
    """Rows whose item enters the pool."""
    keep = positive if cfg.cache_only_pos else F.lit(True)
    if cfg.cache_only_pos and cfg.cache_negative_actions:
        keep = keep | F.arrays_overlap(F.col("actions"), F.array(
            *[F.lit(a) for a in cfg.cache_negative_actions]).cast("array<int>"))
    if 0 <= cfg.origin_neg_in_pool_proba < 1:
        drawn = F.floor(u01("sample_id", "pool") * 100) / F.lit(100.0)
        keep = keep & (positive | (drawn <= cfg.origin_neg_in_pool_proba))
    return keep & (F.col("_ch") != 0)


class Queue:
    """A queue of at most ``capacity`` items as it reads them. An entry is known by the place of the row that brought it."""

    def __init__(self, capacity: int, items: Sequence = (), places: Sequence[int] = ()):
        self.capacity, self.held = capacity, OrderedDict(zip(items, places))
        self.entered: list[int] = []
        self.seen: dict[int, int] = {}

    def read(self, items: list, first: int) -> None:
        """Items of the places from ``first`` on."""
        held, seen, entered = self.held, self.seen, self.entered
        for place, item in enumerate(items, first):
            entry = held.get(item)
            if entry is not None:
                seen[entry] = seen.get(entry, 0) + 1
                continue
            held[item] = place
            seen[place] = 1
            entered.append(place)
            if len(held) > self.capacity:
                held.popitem(last=False)


def queue_entries(rows: DataFrame, capacity: int) -> DataFrame:
    """``(_ch, _item, seq, origin_cnt, req_time, sample_id)``: the entries of each channel's queue in order, with how often the
    item was seen while it stayed.

    What a queue lets in depends on all before it, so a channel is read by one task, in time order, holding the queue and the entries
    of the channel. :func:`queue_chunks` reads a large channel in many tasks."""
    kind = rows.schema["_item"].dataType.simpleString()
    src = rows.select("_ch", "req_time", "sample_id", "_item")
    types = {n: src.schema[n].dataType.simpleString() for n in ("_ch", "req_time", "sample_id")}

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[("req_time", "ascending"), ("sample_id", "ascending")], null_placement="at_start"))
        queue = Queue(capacity)
        queue.read(t["_item"].to_pylist(), 0)
        e = t.take(pa.array(queue.entered, pa.int64()))
        return pa.table({"_ch": e["_ch"], "_item": e["_item"], "seq": pa.array(range(1, len(e) + 1), pa.int64()),
                         "origin_cnt": pa.array([queue.seen[p] for p in queue.entered], pa.int64()), "req_time": e["req_time"], "sample_id": e["sample_id"]})

    return src.groupBy("_ch").applyInArrow(run, f"_ch {types['_ch']}, _item {kind}, seq bigint, origin_cnt bigint, req_time {types['req_time']}, "
                                                f"sample_id {types['sample_id']}")


def queue_chunks(rows: DataFrame, capacity: int, chunk_rows: int = CHUNK_ROWS, hot_rows: int = HOT_ROWS, largest: int | None = None) -> DataFrame:
    """As :func:`queue_entries`, with a channel read by many tasks at once.

    A channel is cut into chunks of its time order. All chunks are read from an empty queue first; then each is read again
    from the queue that the chunk before it left, but only where that is another queue than the one it was read from, until none is. A
    queue forgets its beginning once it has turned over, so a few rounds settle all but odd streams; each round settles at
    least one more chunk of each channel. A chunk holds at least some turns of the queue."""
    size = max(chunk_rows, 4 * capacity) if chunk_rows == CHUNK_ROWS else chunk_rows
    src = positions(rows.select("_ch", "req_time", "sample_id", "_item"), ["_ch"], [F.col("req_time"), F.col("sample_id")], "_p", hot_rows, largest)
    at = F.floor((F.col("_p") - 1) / size).cast("bigint")
    listed = src.groupBy("_ch", at.alias("_chunk")).agg(F.sort_array(F.collect_list(F.struct("_p", "_item", "req_time", "sample_id"))).alias("_rows"))
    chunks = settled(listed.select("_ch", "_chunk", *[F.col(f"_rows.{c}").alias(c) for c in ("_item", "req_time", "sample_id")]))
    kind = {n: src.schema[n].dataType.simpleString() for n in ("_ch", "_item", "req_time", "sample_id")}
    ddl = (f"_ch {kind['_ch']}, _chunk bigint, came array<bigint>, items array<{kind['_item']}>, places array<bigint>, e_item array<{kind['_item']}>, "
           f"e_place array<bigint>, e_cnt array<bigint>, e_time array<{kind['req_time']}>, e_id array<{kind['sample_id']}>, c_place array<bigint>, c_cnt array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(n).slice(i, 1) for n in b.schema.names}
                one = {n: row[n].flatten() for n in ("_item", "req_time", "sample_id", "b_items", "b_places")}
                first = row["_chunk"][0].as_py() * size
                came = one["b_places"].to_pylist()
                queue = Queue(capacity, one["b_items"].to_pylist(), came)
                queue.read(one["_item"].to_pylist(), first)
                take = pa.array([p - first for p in queue.entered], pa.int64())
                mine = set(queue.entered)
                old = {p: n for p, n in queue.seen.items() if p not in mine}
                lists = (pa.array(came, pa.int64()), pa.array(list(queue.held), one["_item"].type), pa.array(list(queue.held.values()), pa.int64()),
                         one["_item"].take(take), pa.array(queue.entered, pa.int64()), pa.array([queue.seen[p] for p in queue.entered], pa.int64()),
                         one["req_time"].take(take), one["sample_id"].take(take), pa.array(list(old), pa.int64()), pa.array(list(old.values()), pa.int64()))
                wrapped = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                yield pa.RecordBatch.from_arrays([row["_ch"], row["_chunk"], *wrapped], names=[
                    "_ch", "_chunk", "came", "items", "places", "e_item", "e_place", "e_cnt", "e_time", "e_id", "c_place", "c_cnt"])

    no_items, no_places = F.array().cast(f"array<{kind['_item']}>"), F.array().cast("array<bigint>")
    done = settled(chunks.withColumns({"b_items": no_items, "b_places": no_places}).mapInArrow(run, ddl))
    while True:
        before = done.select(F.col("_ch").alias("_c"), (F.col("_chunk") + 1).alias("_k"), F.col("items").alias("b_items"), F.col("places").alias("b_places"))
        told = done.select("_ch", "_chunk", "came").join(before, F.col("_ch").eqNullSafe(F.col("_c")) & (F.col("_chunk") == F.col("_k")))
        stale = settled(told.filter("came <> b_places").select("_c", "_k", "b_items", "b_places"))
        if stale.isEmpty():
            break
        same = F.col("_ch").eqNullSafe(F.col("_c")) & (F.col("_chunk") == F.col("_k"))
        again = chunks.join(stale, same).select(*chunks.columns, "b_items", "b_places").mapInArrow(run, ddl)
        done = settled(done.join(stale, same, "left_anti").unionByName(again))

    by = Window.partitionBy("_ch").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk
    numbered = done.withColumn("_base", F.coalesce(F.sum(F.size("e_place")).over(by), F.lit(0)))
    made = numbered.select("_ch", "_base", F.posexplode(F.arrays_zip("e_item", "e_place", "e_cnt", "e_time", "e_id")).alias("_i", "e"))
    carried = done.select("_ch", F.explode(F.arrays_zip("c_place", "c_cnt")).alias("c")).groupBy(F.col("_ch").alias("_c"), F.col("c.c_place").alias("_place")).agg(
        F.sum("c.c_cnt").alias("_more"))
    made = made.join(carried, F.col("_ch").eqNullSafe(F.col("_c")) & (F.col("e.e_place") == F.col("_place")), "left")
    return made.select("_ch", F.col("e.e_item").alias("_item"), (F.col("_base") + F.col("_i") + 1).cast("bigint").alias("seq"),
                       (F.col("e.e_cnt") + F.coalesce("_more", F.lit(0))).alias("origin_cnt"), F.col("e.e_time").alias("req_time"),
                       F.col("e.e_id").alias("sample_id"))


def item_pool(rows: DataFrame, features: Sequence[str] = (), hot_rows: int = HOT_ROWS,
              largest: int | None = None, capacity: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(_ch, _item, seq, origin_cnt, first_at, features…)``: the entries of each channel's queue with the features of the row
    that brought them in.

    A channel with no more items than ``capacity`` never loses one: its entries are the first sights, a partial aggregate of
    which only distinct items are ordered. The other channels go through :func:`queue_entries`, or, where a channel may have more than
    ``chunk_rows`` rows, through :func:`queue_chunks`."""
    at = F.struct("req_time", "sample_id")
    g = rows.groupBy("_ch", "_item").agg(
        F.min(at).alias("first_at"), F.count(F.lit(1)).alias("origin_cnt"),
        *[F.min_by(f, at).alias(f) for f in features])
    if capacity is None:
        return positions(g, ["_ch"], [F.col("first_at")], "seq", hot_rows, largest)
    full = g.groupBy("_ch").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > capacity).select("_ch")
    calm = positions(g.join(full, "_ch", "left_anti"), ["_ch"], [F.col("first_at")], "seq", hot_rows, largest)
    turning = rows.join(full, "_ch", "left_semi")
    most = largest_group(rows, ["_ch"], chunk_rows) if largest is None else largest
    busy = queue_chunks(turning, capacity, chunk_rows, hot_rows, most) if most > chunk_rows else queue_entries(turning, capacity)
    if features:
        busy = busy.join(rows.select("_ch", "sample_id", *features), ["_ch", "sample_id"])
    return calm.unionByName(busy.withColumn("first_at", at).select(*calm.columns))


def pool_state(rows: DataFrame, channel: str, item: str, start_num: int, max_item_num: int,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Final pools: live items per channel with their place in the queue, and whether the pool is
    big enough to be used."""
    base = rows.withColumn("_ch", F.col(channel)).withColumn("_item", F.col(item))
    largest = largest_group(base, ["_ch"], hot_rows)
    pool = item_pool(base, (), hot_rows, largest, max_item_num)
    sized = with_totals(pool, ["_ch"], {"_n": F.max("seq")}, hot_rows, largest)
    live = sized.filter(F.col("seq") > F.col("_n") - max_item_num)
    size = F.least(F.col("_n"), F.lit(max_item_num))
    return live.select(
        F.col("_ch").alias("channel"), F.col("_item").alias("item"), "seq", "origin_cnt",
        size.cast("bigint").alias("pool_size"), (size > start_num).alias("usable"),
        ((F.col("seq") - F.col("_n") + size) / size.cast("double")).alias("time_factor"))


def easy_channels(ask: DataFrame, pool: DataFrame, capacity: int, draw: Column, hot_rows: int = HOT_ROWS, largest: int | None = None) -> DataFrame:
    """``ask`` with ``_easy``: a channel drawn in proportion to the pool sizes at the moment of each row; null while fewer
    than two channels have items.

    Pools only grow up to ``capacity``, so the sum of their sizes is the number of entries that made one grow; the draw picks
    one of those, and its channel."""
    grown = pool.filter(F.col("seq") <= capacity).select("_ch", "seq", F.col("first_at.req_time").alias("req_time"), F.col("first_at.sample_id").alias("sample_id"))
    slots = positions(grown, [], [F.col("req_time"), F.col("sample_id")], "_slot", hot_rows, largest)
    marks = slots.select("req_time", "sample_id", F.lit(0).alias("_q"), F.lit(1).cast("bigint").alias("_one"),
                         (F.col("seq") == 1).cast("bigint").alias("_first"), F.lit(None).cast("int").alias("k"))
    rows = ask.select("req_time", "sample_id", F.lit(1).alias("_q"), F.lit(0).cast("bigint").alias("_one"), F.lit(0).cast("bigint").alias("_first"), "k")
    order = [F.col(c) for c in ("req_time", "sample_id", "_q", "k")]
    seen = running(marks.unionByName(rows), [], order, {"_all": F.col("_one"), "_chs": F.col("_first")}, hot_rows, largest)
    seen = seen.filter("_q = 1").select("sample_id", "k", "_all", "_chs")
    there = ask.join(seen.withColumnsRenamed({"k": "_k"}).withColumnRenamed("sample_id", "_sid"),
                     (F.col("sample_id") == F.col("_sid")) & F.col("k").eqNullSafe(F.col("_k"))).drop("_sid", "_k")
    there = there.withColumn("_slot", F.when(F.col("_chs") >= 2, F.floor(draw * F.col("_all")) + 1))
    return lookup_join(there, slots.select("_slot", F.col("_ch").alias("_easy")), "_slot").drop("_slot", "_all", "_chs")


def draws(samples: DataFrame, cfg: NegativeConfig, hot_rows: int = HOT_ROWS,
          key: str = "sample_id") -> DataFrame:
    """One row per generated negative: the positive's key, ``k``, the drawn item with its cached
    features, ``freq`` and ``time_factor``."""
    pos = is_positive(cfg)
    own = F.col(cfg.channel).cast("bigint") if cfg.per_channel else F.lit(ONE_POOL).cast("bigint")
    base = samples.withColumn("_ch", own).withColumn("_item", F.col(cfg.item))
    easy_draws = cfg.per_channel and cfg.easy_hard_ratio > 0
    # One count bounds every group below; easy draws may gather in any channel.
    rows = largest_group(base, [] if easy_draws else ["_ch"], hot_rows)
    asked = rows * cfg.neg_num
    # read by every step below, and none of them reads the samples for it again
    pool = settled(item_pool(base.filter(is_cached(cfg, pos)), cfg.item_features, hot_rows, rows, cfg.max_item_num))

    ask = base.filter(pos & (F.col("_ch") != 0)).select("_ch", "req_time", key)
    if cfg.neg_num < 1:
        ask = ask.filter("false")
    each = F.explode(F.sequence(F.lit(0), F.lit(max(cfg.neg_num, 1) - 1))).alias("k")
    if easy_draws:
        tag = F.concat_ws("|", F.col(key), F.col("k"))
        easy = u01(tag, "easy") < cfg.easy_hard_ratio
        drawn = easy_channels(ask.select("*", each), pool, cfg.max_item_num, u01(tag, "channel"), hot_rows, rows + asked)
        ask = drawn.withColumn("_ch", F.when(easy, F.coalesce("_easy", "_ch")).otherwise(F.col("_ch"))).drop("_easy")
    else:
        ask = ask.withColumn("k", F.lit(None).cast("int"))

    # Items known at each question: one running sum over first sights and questions together.
    seen = pool.select("_ch", F.col("first_at.req_time").alias("req_time"),
                       F.col("first_at.sample_id").alias(key), F.lit(None).cast("int").alias("k"),
                       F.lit(1).cast("bigint").alias("_new"), F.lit(0).alias("_q"))
    both = seen.unionByName(ask.withColumn("_new", F.lit(0).cast("bigint")).withColumn("_q", F.lit(1)))
    order = [F.col("req_time"), F.col(key), F.col("_q"), F.col("k")]
    known = running(both, ["_ch"], order, {"_n": F.col("_new")}, hot_rows, rows + asked).filter("_q = 1")

    size = F.least("_n", F.lit(cfg.max_item_num))
    ready = known.withColumn("_size", size).filter(F.col("_size") > cfg.start_num)
    if not easy_draws:
        ready = ready.drop("k").select("*", each)
    at = u32(F.concat_ws("|", F.col(key), F.col("k"), F.lit("item"))) % F.col("_size")
    hits = (ready.withColumn("_at", at)
            .withColumn("_pick", F.struct("_ch", (F.col("_n") - F.col("_size") + F.col("_at") + 1).alias("seq"))))
    items = pool.select(F.struct("_ch", "seq").alias("_pick"), "_item", *cfg.item_features)
    got = lookup_join(hits, items, "_pick", "inner", hot_rows, asked)
    # an item that comes back is a new entry: its draws are counted from the start
    got = got.withColumn("_entry", F.col("_pick.seq"))
    counted = positions(got, ["_ch", "_entry"], [F.col("req_time"), F.col(key), F.col("k")], "_drawn", hot_rows, asked)
    return counted.select(key, "k", F.col("_ch").alias("drawn_channel"), F.col("_item").alias("drawn_item"),
                          (F.lit(1.0) / F.col("_drawn")).alias("freq"),
                          ((F.col("_at") + 1.0) / F.col("_size")).alias("time_factor"),
                          *cfg.item_features)


def negative_gen(samples: DataFrame, cfg: NegativeConfig, hot_rows: int = HOT_ROWS,
                 key: str = "sample_id") -> DataFrame:
    """Samples with generated negatives; ``gen_no`` counts the negatives of a positive from 0 and
    is ``neg_num`` for original rows, so ordering by (req_time, key, gen_no) puts negatives first."""
    d = draws(samples, cfg, hot_rows, key).withColumnsRenamed({f: f"_i_{f}" for f in cfg.item_features})
    neg = samples.join(d, key)
    weight = L.sampled_negative_weight(cfg.neg_num, "freq", "time_factor", cfg.decay,
                                       cfg.sampled_neg_instance_weight, cfg.unbias_sampled_neg)
    lab = F.transform("label", lambda x, i: F.when(
        i == cfg.label_index, F.lit(cfg.negative_label)).otherwise(x))
    act = F.col("actions") if cfg.negative_action is None else F.array(F.lit(cfg.negative_action))
    swap = {"label": lab, "actions": act, cfg.item: F.col("drawn_item"), "instance_weight": weight,
            **{f: F.col(f"_i_{f}") for f in cfg.item_features}}
    made = neg.select(*[swap[c].alias(c) if c in swap else F.col(c) for c in samples.columns],
                      F.col("k").alias("gen_no"))
    if cfg.throw_origin:
        return made
    pos = is_positive(cfg)
    origin = samples.filter(pos) if cfg.throw_origin_neg else samples
    origin = origin.withColumn("instance_weight", L.real_weight(pos, cfg.real_neg_instance_weight))
    return made.unionByName(origin.withColumn("gen_no", F.lit(cfg.neg_num)))
