"""Sample-level operators: parsing, conversion, composition of filters, routing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.functions import fid as fids
from sampleloom.functions import labels as L
from sampleloom.functions.base import ColumnLike, col_of, lit_array, lit_map, tail, u01
from sampleloom.functions.vectors import fixed_width

# Fixed value: marker of a missing float of shape 1 (smallest normal FLOAT).
MISSING_FLOAT = 1.1754943508222875e-38

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Layout:
    """What to take from a sample: id lists, dense features with shape and type, LineId fields
    with shape (0 for a scalar)."""

    sparse: tuple[str, ...] = ()
    dense: dict[str, tuple[int, str]] = field(default_factory=dict)
    extra: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = [*self.sparse, *self.dense, *self.extra]
        if len(names) != len(set(names)):
            raise ValueError("feature names must be unique")
        for name, (shape, kind) in self.dense.items():
            if shape <= 0:
                raise ValueError(f"dense shape of {name} must be positive")
            if kind not in ("float", "int", "string"):
                raise ValueError(f"unsupported dense type {kind}")
            if kind == "string" and shape != 1:
                raise ValueError("text features have shape 1")


def dense_column(c: ColumnLike, shape: int, kind: str = "float") -> Column:
    """Dense feature as a scalar (shape 1) or a list of exactly ``shape`` values."""
    v = col_of(c)
    if shape == 1:
        one = F.get(v, F.lit(0))
        if kind == "float":
            return F.coalesce(one.cast("double"), F.lit(MISSING_FLOAT))
        return F.coalesce(one.cast("bigint"), F.lit(0)) if kind == "int" else one.cast("string")
    if kind == "int":
        v = F.coalesce(v.cast("array<bigint>"), F.array().cast("array<bigint>"))
        return F.slice(F.concat(v, F.array_repeat(F.lit(0).cast("bigint"), shape)), 1, shape)
    return fixed_width(v.cast("array<double>"), shape)


def line_id_field(df: DataFrame, name: str, shape: int, line_id: str = "line_id") -> Column:
    """LineId field as a column; a repeated one is cut to ``shape``."""
    struct = df.schema[line_id].dataType
    if name not in struct.names:
        raise ValueError(f"{name} is not a LineId field; known: {struct.names}")
    kind = struct[name].dataType
    base = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if isinstance(base, (T.BooleanType, T.StructType)):
        raise ValueError(f"LineId field {name} has an unsupported type {base.simpleString()}")
    c = F.col(line_id).getField(name)
    return F.slice(c, 1, shape) if isinstance(kind, T.ArrayType) else c


def parse_samples(df: DataFrame, layout: Layout, keep: Sequence[str] = ()) -> DataFrame:
    """Project a sample table to the declared columns; Catalyst prunes the scan to them."""
    cols = [F.col(k) for k in keep]
    cols += [F.coalesce(F.col(n), F.array().cast("array<bigint>")).alias(n) for n in layout.sparse]
    cols += [dense_column(n, s, k).alias(n) for n, (s, k) in layout.dense.items()]
    cols += [line_id_field(df, n, s).alias(n) for n, s in layout.extra.items()]
    return df.select(*cols)


def select_by_fids(features: DataFrame, wanted: Sequence[int], version: int = 2) -> DataFrame:
    """Rows of ``(…, slot, …)`` whose slot is the slot of one of the given ids."""
    slots = F.array_distinct(F.transform(lit_array(wanted, "bigint"),
                                         lambda f: fids.slot_of(f, version)))
    return features.filter(F.array_contains(slots, F.col("slot").cast("int")))


def explode_request(df: DataFrame, shared: Sequence[str], instances: str) -> DataFrame:
    """One row per nested instance with the shared request columns."""
    return df.select(*shared, F.posexplode(instances).alias("pos", "_i")).select(
        *shared, "pos", "_i.*")


def fids_to_map(ids: ColumnLike, prefix: str = "fc_slot_") -> Column:
    """Flat v1 ids grouped by slot into ``map<fc_slot_N, ids>`` (order kept)."""
    v = col_of(ids)
    slots = F.array_distinct(F.transform(v, lambda f: fids.slot_of(f, 1)))
    return F.map_from_entries(F.transform(slots, lambda s: F.struct(
        F.concat(F.lit(prefix), s.cast("string")),
        F.filter(v, lambda f: fids.slot_of(f, 1) == s))))


def map_to_fids(features: ColumnLike) -> Column:
    """Inverse of :func:`fids_to_map`: all ids of all features."""
    return F.flatten(F.map_values(col_of(features)))


def _id_in(slot: int) -> Callable[[Column], Column]:
    return lambda x: fids.make_fid(slot, x)


def _bucket_in(slot: int) -> Callable[[Column], Column]:
    return lambda x: fids.make_fid(slot, fids.float_bucket(x))


def flat_to_sample(df: DataFrame, sparse: dict[str, int], dense: Sequence[str], label: str,
                   instance_weight: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Flat record to sample: integers become ids of their slot, floats ids of their log2 bucket,
    dense features are copied, the weight defaults to 1. Other columns are dropped."""
    if set(sparse) & set(dense):
        raise ValueError("a feature cannot be sparse and dense")
    if len(set(sparse.values())) != len(sparse):
        raise ValueError("every sparse feature needs its own slot")
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = (set(sparse) | set(dense) | {label}) - set(types)
    if missing:
        raise ValueError(f"columns not found: {sorted(missing)}")
    cols = [F.col(k) for k in keep]
    for name, slot in sparse.items():
        kind = types[name]
        many = isinstance(kind, T.ArrayType)
        base = kind.elementType if many else kind
        v = F.col(name) if many else F.array(name)
        if isinstance(base, T.IntegralType):
            cols.append(F.transform(v, _id_in(slot)).alias(name))
        elif isinstance(base, (T.FloatType, T.DoubleType)):
            cols.append(F.transform(v, _bucket_in(slot)).alias(name))
        else:
            raise ValueError(f"sparse feature {name} must be integer or float")
    cols += [F.col(d) for d in dense]
    weight = F.coalesce(F.col(instance_weight).cast("double"), F.lit(1.0)) if instance_weight else F.lit(1.0)
    return df.select(*cols, F.col(label), weight.alias("instance_weight"))


# ---------------------------------------------------------------- composition

def compose(*steps: Transform) -> Transform:
    """Apply steps in sequence; Catalyst merges neighbouring filters into one."""
    return lambda df: reduce(lambda d, s: d.transform(s), steps, df)


def keep_if(predicate: Column) -> Transform:
    return lambda df: df.filter(predicate)


def with_label(key: str, config: str, negative_value: float = 0.0) -> Transform:
    return lambda df: df.withColumn("label", L.add_label(key, "label", "actions", config, negative_value))


def logical_or(left: Column, right: Column) -> Transform:
    """Keep rows that pass either predicate, once."""
    return keep_if(left | right)


def retention(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Per filter of a sequence the rows that reach it, the rows that pass, and their share, all in
    one pass."""
    cols, alive = [], F.lit(True)
    for name, p in predicates.items():
        passed = alive & p
        cols.append(F.struct(F.lit(name).alias("transform"),
                             F.count(F.when(alive, 1)).alias("input"),
                             F.count(F.when(passed, 1)).alias("output")))
        alive = passed
    return df.agg(F.array(*cols).alias("_s")).select(F.inline("_s")).withColumn(
        "retention", F.when(F.col("input") > 0, F.col("output") / F.col("input")).otherwise(0.0))


def filtered(df: DataFrame, predicates: dict[str, Column], seen: Observation) -> DataFrame:
    """Rows that pass all filters. ``seen`` counts, in the run that uses them, the rows that reach each filter and those that pass
    it; read them with :func:`retention_of`."""
    alive, counts = F.lit(True), [F.count(F.lit(1)).alias("in")]
    for i, p in enumerate(predicates.values()):
        alive = alive & F.coalesce(p, F.lit(False))
        counts.append(F.count(F.when(alive, 1)).alias(f"out_{i}"))
    return df.observe(seen, *counts).filter(alive)


def retention_of(predicates: dict[str, Column], seen: Observation) -> list[tuple[str, int, int, float]]:
    """Name, rows in, rows out and their share for each filter of :func:`filtered`, after its run."""
    got, came, out = seen.get, None, []
    for i, name in enumerate(predicates):
        came = got["in"] if came is None else came
        out.append((name, came, got[f"out_{i}"], got[f"out_{i}"] / came if came else 0.0))
        came = got[f"out_{i}"]
    return out


# ---------------------------------------------------------------- row operators

def special_strategy(df: DataFrame, strategies: Sequence[int], rates: dict[int, float],
                     labels: dict[int, float] | None = None, keep_empty: bool = False,
                     key: str = "sample_id", column: str = "special_strategies") -> DataFrame:
    """The first listed strategy of a row decides: keep with its rate (1 when it has none) and
    overwrite the first label if one is given. Rows without strategies follow ``keep_empty``; rows
    with only unlisted strategies are dropped."""
    has = F.coalesce(F.col(column), F.array().cast("array<int>"))
    first = F.get(F.filter(lit_array(strategies, "int"), lambda s: F.array_contains(has, s)), F.lit(0))
    rate = F.coalesce(lit_map(rates, "int", "double")[first], F.lit(1.0)) if rates else F.lit(1.0)
    kept = (F.when(F.size(has) == 0, F.lit(keep_empty))
            .when(first.isNull(), F.lit(False))
            .otherwise((rate == 1.0) | (u01(key, "strategy") <= rate)))
    out = df.filter(kept)
    if not labels:
        return out
    new = lit_map(labels, "int", "double")[first]
    changed = F.concat(F.array(new), tail(F.col("label"), 1))
    return out.withColumn("label", F.when(new.isNotNull(), changed).otherwise(F.col("label")))


def negative_sample(df: DataFrame, drop_rate: float, label_index: int = 0, threshold: float = 0.0,
                    priority: Sequence[int] = (), action_rates: dict[int, float] | None = None,
                    key: str = "sample_id") -> DataFrame:
    """Drop part of the negatives, with the rate of the row's highest-priority action if listed."""
    from sampleloom.functions.predicates import negative_kept

    rate: Column | float = drop_rate
    if action_rates:
        act = L.most_prior_action("actions", priority, fallback_first=False)
        rate = F.coalesce(lit_map(action_rates, "int", "double")[act], F.lit(float(drop_rate)))
    lab = F.get("label", F.lit(label_index))
    return df.filter(negative_kept(key, lab, rate, threshold))


def instance_reweight(df: DataFrame, priority: Sequence[int], table: dict[int, tuple[int, int]],
                      additive: bool = False) -> DataFrame:
    """Replicate each row by its weight and relabel it; rows with no copies disappear."""
    parts = {f"_{side}{i}": c for side, col in (("c", "actions"), ("p", "pre_actions"))
             for i, c in enumerate(L.reweight_columns(col, priority, table, additive))}
    cur, pre = ([F.col(f"_{side}{i}") for i in range(3)] for side in "cp")
    r = L.reweight_result(F.get("label", F.lit(0)), cur, pre, len(priority) + 1, table)
    changed = F.concat(F.array(F.col("_r.label")), tail(F.col("label"), 1))
    rows = df.withColumns(parts).withColumn("_r", r).filter("_r.copies > 0").withColumn("label", changed)
    return rows.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_r.copies"))).alias("copy_no"))


def merge_flow(flows: dict[str, DataFrame]) -> DataFrame:
    """Union of equally typed flows, each row tagged with its source."""
    parts = [f.withColumn("data_source_name", F.lit(f"data_source{k}")) for k, f in flows.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def split_flow(df: DataFrame, flows: Sequence[str], key: str = "data_source_key") -> dict[str, DataFrame]:
    """One frame per named flow, by data source key. Each is a filter over the same scan."""
    return {n: df.filter(F.col(key) == fids.data_source_key(F.lit(n))) for n in flows}


def route_flow(df: DataFrame, flows: Sequence[str], key: str = "data_source_key") -> DataFrame:
    """All flows in one pass: the flow name as a column, ready for ``partitionBy``."""
    name = F.coalesce(*[F.when(F.col(key) == fids.data_source_key(F.lit(n)), F.lit(n)) for n in flows])
    return df.withColumn("flow", name).filter("flow is not null")


def drop_empty(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Usable rows and the quarantined empty ones."""
    ok = F.coalesce(F.length(column) > 0, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def shard_rows(df: DataFrame, key: str, shards: int, index: int) -> DataFrame:
    """The ``index``-th of ``shards`` repeatable row shares."""
    from sampleloom.functions.base import u32

    return df.filter(F.pmod(u32(F.col(key).cast("string")), F.lit(shards)) == index)
