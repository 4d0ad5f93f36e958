"""Query registry: a Spark plan and, where SQL can say the same, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("q_scans", "q_filters", "q_labels", "q_pooling", "q_ids", "q_tables", "q_negatives",
           "q_ranking", "q_streaming", "q_sinks")


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f
    return add


def load() -> None:
    for m in MODULES:
        import_module(f"sampleloom.plans.{m}")


# ---- comparable output: both engines print numbers the same way

def r6(c: Column | str) -> Column:
    """Half-up rounding to 6 places, spelled out so that both engines agree to the bit."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e6 + 0.5).cast("double") / 1e6


def vec(c: Column | str) -> Column:
    """Vector as text of millionths."""
    return F.array_join(F.transform(c, lambda x: F.floor(x * 1e6 + 0.5).cast("bigint").cast("string")), ",")


def ints(c: Column | str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def labs(c: Column | str) -> Column:
    """Labels as text of ten-thousandths; INV marks the invalid value."""
    return F.array_join(F.transform(c, lambda x: F.when(x < -1e30, F.lit("INV")).otherwise(
        F.floor(x * 1e4 + 0.5).cast("bigint").cast("string"))), ",")


# ---- the same in DuckDB

def s_r6(e: str) -> str:
    return f"(floor(({e}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE)"


def s_vec(e: str) -> str:
    return (f"array_to_string(list_transform({e}, lambda x: CAST(floor(x * 1000000.0::DOUBLE + 0.5::DOUBLE)"
            " AS BIGINT)), ',')")


def s_ints(e: str) -> str:
    return f"array_to_string({e}, ',')"


def s_labs(e: str) -> str:
    return (f"array_to_string(list_transform({e}, lambda x: CASE WHEN x < -1e30::DOUBLE THEN 'INV' ELSE "
            "CAST(CAST(floor(x * 10000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR) END), ',')")


def s_u(key: str, salt: str) -> str:
    """Repeatable uniform number from a key and a salt (both SQL text)."""
    return (f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|' || {salt}), 1, 8) AS BIGINT)"
            " / 4294967296.0::DOUBLE)")


def s_u32(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


INV = "(-3.4028234663852886e38::DOUBLE)"
MASK48 = (1 << 48) - 1
MASK54 = (1 << 54) - 1
