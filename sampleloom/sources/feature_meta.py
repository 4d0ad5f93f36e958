"""Feature metadata: configuration lines as a table, names and slots, and pruning to used features."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feature_meta(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``key=value; key=value`` as rows of the feature table. Lists are comma-separated; lines
    without a name or an equals sign are left out."""
    clean = F.regexp_replace("value", r"\s*([;=,])\s*", "$1")
    kv = spark.read.text(path).filter(F.col("value").contains("=")).select(
        F.str_to_map(F.trim(clean), F.lit(";"), F.lit("=")).alias("m"))

    def words(key: str):
        return F.split(F.regexp_replace(F.col("m")[key], "[\"']", ""), ",")

    def flag(key: str):
        return F.lower(F.col("m")[key]).isin("true", "1", "t", "y", "yes")

    def number(key: str, kind: str):
        return F.expr(f"try_cast(m['{key}'] AS {kind})")

    out = kv.select(
        F.coalesce(F.col("m")["feature_name"], F.col("m")["feed_name"]).alias("name"), number("slot", "int").alias("slot"),
        number("feature_id", "bigint").alias("feature_id"), number("feature_version", "int").alias("version"),
        F.coalesce(flag("shared"), F.lit(False)).alias("shared"), F.coalesce(flag("need_raw"), F.lit(False)).alias("need_raw"),
        F.col("m")["method"].alias("method"), words("depend").alias("depend"), words("args").alias("args"),
        words("feature_group").alias("feature_group"))
    return out.filter(F.col("name").isNotNull())


def by_slots(meta: DataFrame, slots: Sequence[int]) -> DataFrame:
    """Feature rows of the given slots."""
    return meta.filter(F.col("slot").isin(list(slots)))


def slot_name(slot: int, combined: bool = False) -> str:
    return f"{'fc_' if combined else ''}slot_{slot}"


class SlotNames:
    """Names to slots: registered names first, then ``slot_N`` and ``fc_slot_N``, then the next free
    number, remembered."""

    def __init__(self, registered: dict[str, int] | Sequence[int] = (), combined: bool = False) -> None:
        if not isinstance(registered, dict):
            registered = {slot_name(s, combined): s for s in registered}
        self.registered = dict(registered)
        self.given: dict[str, int] = {}

    def slot(self, name: str) -> int | None:
        if name in self.registered:
            return self.registered[name]
        if re.match(r"(fc_)?slot_", name):
            tail = name.rsplit("_", 1)[-1]
            return int(tail) if tail.isdigit() else None
        return self.given.setdefault(name, len(self.given) + 1)


def resolve(columns: Sequence[str], name: str) -> str:
    """Column of a feature name: as it is, or with the prefix ``f_`` or ``fc_`` (on every part of a
    joined name)."""
    name, have = name.strip(), set(columns)
    joined = ["-".join(p + part for part in name.split("-")) for p in ("fc_", "f_")] if "-" in name else []
    for c in (name, f"f_{name}", f"fc_{name}", *joined):
        if c in have:
            return c
    raise ValueError(f"there is no feature {name}")


def prune_features(df: DataFrame, used: Sequence[str], keep: Sequence[str] = (), drop_raw: bool = True) -> DataFrame:
    """Only the features in use and the ``keep`` columns; raw features (``…_raw``) go unless asked
    for. The scan then reads nothing else."""
    cols = [resolve(df.columns, n) for n in used]
    if drop_raw:
        cols = [c for c in cols if not c.endswith("_raw")]
    return df.select(*dict.fromkeys([*keep, *cols]))
