"""Whole-frame feature edits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sampleloom.functions.fid import switch_slot


def switch_slots(df: DataFrame, plan: dict[str, tuple[bool, int]], suffix: str = "share",
                 version: int = 2) -> DataFrame:
    """Move features to other slots: ``plan`` maps a feature to (in place?, slot). A feature that is
    not changed in place gets a copy named ``<feature>_<suffix>``."""
    new = {(f if in_place else f"{f}_{suffix}"): switch_slot(f, slot, version)
           for f, (in_place, slot) in plan.items()}
    return df.withColumns(new)
