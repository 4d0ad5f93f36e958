"""Queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("ann", "token_files", "secrets", "suffixes", "minhash", "pieces", "packing", "toxicity", "quality", "ngram_lm", "whitening", "negatives", "jaccard")


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f
    return add


def load() -> None:
    for m in MODULES:
        import_module(f"sampleloom.llm.{m}")
