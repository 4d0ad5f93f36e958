"""Embedding tables: rows ``(table, fid, num ARRAY<DOUBLE>, opt STRUCT, last_update_ts BIGINT)``.

Each operation is a pure function from one table version to the next. Updates are reduced to one
row per id before they meet the table, and the table itself is joined on its key once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import vectors as V
from sampleloom.functions.base import ColumnLike, col_of, lit_map, u01
from sampleloom.functions.fid import slot_of
from sampleloom.functions.optimizers import rule
from sampleloom.operators.gradients import merge_gradients
from sampleloom.operators.joins import lookup_join
from sampleloom.operators.ordering import HOT_ROWS, first_in_key, positions

KEY = ["table", "fid"]
DEFAULT_EXPIRE_DAYS = 36500  # fixed value


# ---------------------------------------------------------------- initial values

def initial_vector(fid: ColumnLike, dim: int, kind: str = "zeros", value: float = 0.0,
                   low: float = -0.05, high: float = 0.05) -> Column:
    """Start vector of an unseen id: ``zeros``, ``ones``, ``constant``, or ``uniform`` drawn
    repeatably from the id."""
    if kind == "uniform":
        return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                           lambda i: u01(col_of(fid), i) * F.lit(high - low) + F.lit(low))
    fixed = {"zeros": 0.0, "ones": 1.0, "constant": float(value)}
    if kind not in fixed:
        raise ValueError(f"unknown initializer {kind}")
    return F.array_repeat(F.lit(fixed[kind]), dim)


def concat_initial(parts: Sequence[Column]) -> Column:
    return F.concat(*parts)


# ---------------------------------------------------------------- upserts

def last_vector(seq: str, dim: int) -> Column:
    """The vector, of width ``dim``, of the row with the largest ``seq``, as an aggregate. A maximum per element has a fixed-width
    buffer, so rows are hashed by id; an array in the buffer would have each task sort all its rows with their vectors."""
    num = V.doubles("num")
    last = F.array(*[F.max_by(F.get(num, F.lit(i)), F.col(seq)) for i in range(dim)])
    return F.when(F.max_by(num.isNotNull(), F.col(seq)), last)


def last_writes(updates: DataFrame, seq: str, dim: int, ts: str | None = None) -> DataFrame:
    """The last write of each id: ``(table, fid, num)`` and, with ``ts``, the latest time of any of its writes."""
    times = [] if ts is None else [F.max(ts).alias(ts)]
    return updates.groupBy(*KEY).agg(last_vector(seq, dim).alias("num"), *times)


def _latest(updates: DataFrame, seq: str | None, ts: str, distinct: bool = False, dim: int | None = None) -> DataFrame:
    if not distinct and seq is not None and dim is not None:
        updates, distinct = last_writes(updates, seq, dim, ts), True
    if distinct:
        return updates.select(*KEY, V.doubles("num").alias("_new"), F.col(ts).alias("_ts"))
    order = F.col(seq) if seq is not None else F.struct(ts, V.doubles("num"))
    return updates.groupBy(*KEY).agg(F.max_by(V.doubles("num"), order).alias("_new"), F.max(ts).alias("_ts"))


def _joined(table: DataFrame, changes: DataFrame) -> DataFrame:
    return table.join(changes, KEY, "full_outer")


def assign(table: DataFrame, updates: DataFrame, seq: str | None = None, ts: str = "ts",
           skip_zero: bool = False, distinct: bool = False, dim: int | None = None) -> DataFrame:
    """Set vectors; the last write of an id wins: the one with the largest ``seq`` or, without it, with the latest time
    (at equal times the larger vector), so an id never gets two rows. ``distinct`` says that the updates hold each id once, which saves
    finding its last write. ``dim``, the width of all vectors, lets writes with a ``seq`` be hashed by id instead of sorted. With ``skip_zero`` an
    all-zero vector deletes."""
    j = _joined(table, _latest(updates, seq, ts, distinct, dim))
    out = j.select(*KEY, F.coalesce("_new", "num").alias("num"), "opt",
                   F.coalesce("_ts", "last_update_ts").alias("last_update_ts"), "_new")
    if skip_zero:
        zero = F.col("_new").isNotNull() & (V.sum_squares(F.coalesce("_new", F.array())) == 0)
        out = out.filter(~F.coalesce(zero, F.lit(False)))
    return out.drop("_new")


def assign_add(table: DataFrame, updates: DataFrame, dim: int, ts: str = "ts",
               initial: Column | None = None) -> DataFrame:
    """Add to vectors; a missing id starts from its initial value."""
    sums = updates.groupBy(*KEY).agg(F.array(*V.sum_agg("num", dim)).alias("_new"),
                                     F.max(ts).alias("_ts"))
    start = V.zeros(dim) if initial is None else initial
    base = F.coalesce(F.col("num"), start)
    num = F.when(F.col("_new").isNull(), F.col("num")).otherwise(
        V.unrolled(dim, lambda i: F.get(base, F.lit(i)) + F.get("_new", F.lit(i))))
    return _joined(table, sums).select(*KEY, num.alias("num"), "opt",
                                       F.coalesce("_ts", "last_update_ts").alias("last_update_ts"))


def reinitialize(table: DataFrame, ids: DataFrame, dim: int, initial: Column | None = None) -> DataFrame:
    """``(table, fid, existed, num)`` of the reset ids: their start vector and whether they were
    present. Feed it to :func:`assign`."""
    start = V.zeros(dim) if initial is None else initial
    have = table.select(*KEY, F.lit(True).alias("_have"))
    return (ids.select(*KEY).distinct().join(have, KEY, "left")
            .select(*KEY, F.coalesce("_have", F.lit(False)).alias("existed"), start.alias("num")))


# ---------------------------------------------------------------- optimizer steps

@dataclass(frozen=True)
class Segment:
    """Part of an entry with its own optimizer and start value."""

    dim: int
    optimizer: str
    params: tuple[tuple[str, float], ...] = ()
    initializer: str = "zeros"

    @property
    def overrides(self) -> dict[str, float]:
        return dict(self.params)


def _with_results(df: DataFrame, segments: Sequence[Segment], lr: ColumnLike | float | None) -> DataFrame:
    """Add ``_r0, _r1, …``: the step of each segment on the columns num, _g and opt. Slices and
    states become columns of their own first, so that no element recomputes them."""
    inputs, at = {}, 0
    for i, s in enumerate(segments):
        whole = len(segments) == 1
        inputs[f"_w{i}"] = F.col("num") if whole else V.piece("num", at, at + s.dim)
        inputs[f"_d{i}"] = F.col("_g") if whole else V.piece("_g", at, at + s.dim)
        inputs[f"_o{i}"] = F.coalesce(F.col(f"opt.s{i}"), rule(s.optimizer).initial(s.dim, **s.overrides))
        at += s.dim
    ready = df.withColumns(inputs)
    return ready.withColumns({f"_r{i}": rule(s.optimizer).apply(f"_w{i}", f"_d{i}", f"_o{i}", lr, **s.overrides)
                              for i, s in enumerate(segments)})


def opt_type(segments: Sequence[Segment]) -> str:
    return "struct<" + ",".join(f"s{i}:{rule(s.optimizer).state_type}" for i, s in enumerate(segments)) + ">"


def with_empty_state(table: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """Give a table without optimizer state the right (NULL) state column."""
    return table.withColumn("opt", F.lit(None).cast(opt_type(segments)))


def apply_gradients(table: DataFrame, grads: DataFrame, segments: Sequence[Segment], now: int | Column,
                    lr: ColumnLike | float | None = None, merged: bool = False) -> DataFrame:
    """One optimizer step: gradients of equal ids are summed, touched ids updated segment by
    segment, unseen ids initialised first; all other rows pass through unchanged."""
    dim = sum(s.dim for s in segments)
    g = grads if merged else merge_gradients(grads, dim, tuple(KEY))
    g = g.select(*KEY, V.doubles("grad").alias("_g"))
    starts, at = [], 0
    for s in segments:
        starts.append(initial_vector(F.concat_ws("|", "fid", F.lit(at)), s.dim, s.initializer))
        at += s.dim
    now_c = now if isinstance(now, Column) else F.lit(now).cast("bigint")
    j = _joined(table, g).withColumn("num", F.coalesce(F.col("num"), F.concat(*starts)))
    # Computed for every row, NULL gradients included, so that the step is not behind a condition.
    j = _with_results(j, segments, lr)
    touched = F.col("_g").isNotNull()
    new_num = F.concat(*[F.col(f"_r{i}.num") for i in range(len(segments))])
    new_opt = F.struct(*[F.col(f"_r{i}.opt").alias(f"s{i}") for i in range(len(segments))])
    return j.select(*KEY, F.when(touched, new_num).otherwise(F.col("num")).alias("num"),
                    F.when(touched, new_opt).otherwise(F.col("opt")).cast(opt_type(segments)).alias("opt"),
                    F.when(touched, now_c).otherwise(F.col("last_update_ts")).alias("last_update_ts"))


def update_tables(tables: DataFrame, dim: int, assigns: DataFrame | None = None, adds: DataFrame | None = None,
                  grads: DataFrame | None = None, segments: Sequence[Segment] = (),
                  now: int = 0, seq: str | None = None) -> DataFrame:
    """Assign, add and optimise several named tables in one chained plan. All steps join on the
    same key, so the partitioning of the first carries through. ``seq`` orders the assigns, as in :func:`assign`."""
    out = tables
    if assigns is not None:
        out = assign(out, assigns, seq, dim=dim)
    if adds is not None:
        out = assign_add(out, adds, dim)
    if grads is not None:
        out = apply_gradients(out, grads, segments, now)
    return out


# ---------------------------------------------------------------- layout and life cycle

def merged_name(names: Sequence[str]) -> str:
    """Name of a merged table: md5 of the sorted, comma-joined names."""
    return hashlib.md5(",".join(sorted(names)).encode()).hexdigest()


def merge_plan(configs: dict[str, str]) -> dict[str, str]:
    """Table name to merged name; tables with equal configuration text share one."""
    groups: dict[str, list[str]] = {}
    for name in sorted(configs):
        groups.setdefault(configs[name], []).append(name)
    return {n: merged_name(g) for g in groups.values() for n in g}


def restore_names(configs: dict[str, str], extra: dict[str, Sequence[str]] | None = None) -> dict[str, list[str]]:
    """For each merged table the names that it may be stored under, its own first: then the name from before its slots were called
    ``fc_slot_N``, then those of ``extra`` for any of its tables."""
    groups: dict[str, list[str]] = {}
    for name, merged in merge_plan(configs).items():
        groups.setdefault(merged, []).append(name)
    out = {}
    for merged, names in groups.items():
        old = merged_name([n[3:] if re.fullmatch("fc_slot_[0-9]*", n) else n for n in names])
        more = [x for n in sorted(names) for x in (extra or {}).get(n, ())]
        out[merged] = list(dict.fromkeys([merged, old, *more]))
    return out


def resolve_names(wanted: dict[str, Sequence[str]], stored: Sequence[str]) -> dict[str, str]:
    """Stored name to table name, by the first name of each table that is stored. Two tables that would read the same stored
    one are refused; a table with no stored name starts empty."""
    there, out = set(stored), {}
    for table, names in wanted.items():
        found = next((n for n in names if n in there), None)
        if found is None:
            continue
        if found in out:
            raise ValueError(f"tables {out[found]} and {table} would both be restored from {found}")
        out[found] = table
    return out


def restore_merged(saved: DataFrame, configs: dict[str, str], extra: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """A save with its tables under the merged names of ``configs``, also where it was made under older ones. Stored tables that no
    configuration asks for are left out."""
    stored = [r["table"] for r in saved.select("table").distinct().collect()]  # a name for each table
    names = resolve_names(restore_names(configs, extra), stored)
    if not names:
        return saved.filter("false")
    return saved.filter(F.col("table").isin(list(names))).withColumn("table", lit_map(names, "string", "string")[F.col("table")])


def merge_tables(tables: DataFrame, configs: dict[str, str]) -> DataFrame:
    """Rewrite the table column to merged names; ids must differ between merged tables."""
    return tables.withColumn("table", F.coalesce(
        lit_map(merge_plan(configs), "string", "string")[F.col("table")], F.col("table")))


def table_sizes(tables: DataFrame) -> DataFrame:
    return tables.groupBy("table").agg(F.count(F.lit(1)).alias("entries"),
                                       F.max("last_update_ts").alias("max_update_ts"))


def iterate(tables: DataFrame, shards: int, shard: int, limit: int, offset: int = 0,
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """Page ``offset … offset + limit`` of one shard of each table, in id order."""
    mine = tables.filter(F.pmod("fid", F.lit(shards).cast("bigint")) == shard)
    n = positions(mine, ["table"], [F.col("fid")], "_pos", hot_rows)
    return n.filter((F.col("_pos") > offset) & (F.col("_pos") <= offset + limit)).drop("_pos")


def page_after(tables: DataFrame, shards: int, shard: int, limit: int, after: int | None = None) -> DataFrame:
    """The next ``limit`` entries of one shard of each table behind the id ``after`` (None: from the start), in id order. Nothing is
    numbered: each task keeps its first ``limit`` entries. Entries that come or go between two pages move no other."""
    mine = tables.filter(F.pmod("fid", F.lit(shards).cast("bigint")) == shard)
    mine = mine if after is None else mine.filter(F.col("fid") > after)
    return first_in_key(mine, ["table"], limit, [F.col("fid")], "_pos").drop("_pos")


def expired(fid: ColumnLike, last_ts: ColumnLike, max_ts: Column, expire_days: dict[int, int],
            default_days: int = DEFAULT_EXPIRE_DAYS) -> Column:
    """Age in seconds reaches the days of the id's (v2) slot."""
    days = F.lit(default_days)
    if expire_days:
        days = F.coalesce(lit_map(expire_days, "int", "int")[slot_of(fid, 2)], days)
    return (max_ts - col_of(last_ts)) >= days.cast("bigint") * 86400


def evict(tables: DataFrame, expire_days: dict[int, int], default_days: int = DEFAULT_EXPIRE_DAYS,
          keep_expired: bool = False) -> DataFrame:
    """Tables without the entries that expired against the newest update time of their own table; or only
    those entries. An absent time counts as 0, so each entry is on one of the two sides."""
    newest = tables.groupBy(F.col("table").alias("_t")).agg(F.coalesce(F.max("last_update_ts"), F.lit(0)).alias("_newest"))
    dead = expired("fid", F.coalesce("last_update_ts", F.lit(0)), F.col("_newest"), expire_days, default_days)
    both = tables.join(newest, F.col("table").eqNullSafe(F.col("_t")))  # one row per table: small, as Spark measures
    return both.filter(dead if keep_expired else ~dead).select(*tables.columns)


def delta_since(tables: DataFrame, touched: DataFrame, chunk: int, buckets: int = 64,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Current vectors of the touched ids, cut into messages ``(table, bucket, chunk_no)`` of at most
    ``chunk`` entries. Numbering inside hash buckets keeps a big table off a single task."""
    hit = tables.join(touched.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, "num")
    hit = hit.withColumn("bucket", F.pmod("fid", F.lit(buckets).cast("bigint")).cast("int"))
    n = positions(hit, ["table", "bucket"], [F.col("fid")], "_pos", hot_rows)
    return n.select("table", "bucket", F.floor((F.col("_pos") - 1) / F.lit(chunk)).cast("bigint").alias("chunk_no"),
                    "fid", "num")


def delta_apply(serving: DataFrame, delta: DataFrame) -> DataFrame:
    """Serving copy ``(table, fid, num)`` with pushed vectors overwritten."""
    d = delta.select(*KEY, F.col("num").alias("_new"))
    return serving.join(d, KEY, "full_outer").select(*KEY, F.coalesce("_new", "num").alias("num"))


def contains(ids: DataFrame, tables: DataFrame, present: bool = True) -> DataFrame:
    """Rows of ``ids`` whose (table, fid) is, or is not, in the tables."""
    key = F.struct(*KEY).alias("_k")
    out = lookup_join(ids.select("*", key), tables.select(key), "_k", "left_semi" if present else "left_anti")
    return out.select(*ids.columns)


def lookup_entry(ids: DataFrame, tables: DataFrame) -> DataFrame:
    """Full entries (vector, optimizer state, timestamp) of the distinct ids that exist."""
    return ids.select(*KEY).distinct().join(tables, KEY)


def union_tables(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
