"""Vector tables as keyed state of a stream: an entry per id, touched only by the rows of that id.

Each (table, id) is a key of its own with its vector, optimizer state and time of the last update. A micro-batch reads and
writes the entries of its ids and nothing else; what it changed comes out as the rows of the stream, which is the delta
that a serving copy needs. Entries expire by a timer of their own, so no batch looks through the table. Lookups
read the state of a finished batch from the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Gradient of the rows of one id, given its vector; called for parts of the rows, whose gradients are added.
Gradient = Callable[[np.ndarray, pd.DataFrame], np.ndarray]
#: Vector and optimizer state after one gradient.
Rule = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

ENTRY = "num array<double>, opt array<double>, last_update_ts bigint"
CHANGES = f"table string, fid bigint, {ENTRY}, gone boolean"


def sgd(lr: float) -> Rule:
    return lambda num, opt, grad: (num - lr * grad, opt)


def adagrad(lr: float, start: float = 0.1) -> Rule:
    """Sums of squares start at ``start``."""
    def step(num: np.ndarray, opt: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = (opt if len(opt) else np.full(len(num), start)) + grad * grad
        return num - lr / np.sqrt(total) * grad, total
    return step


class TableProcessor(StatefulProcessor):
    """One entry. Ids without an entry begin with ``first``, or stay unknown if it is None."""

    def __init__(self, gradient: Gradient, rule: Rule, first: list[float] | None, expire_ms: int | None) -> None:
        self.gradient, self.rule, self.first, self.expire_ms = gradient, rule, first, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", ENTRY)

    def _keep(self, key, num: np.ndarray, opt: np.ndarray, ts: int, gone: bool = False) -> pd.DataFrame:
        value = (num.tolist(), opt.tolist(), ts)
        if gone:
            self.entry.clear()
        else:
            self.entry.update(value)
        row = {"table": [key[0]], "fid": [key[1]], "num": [value[0]], "opt": [value[1]], "last_update_ts": [ts], "gone": [gone]}
        return pd.DataFrame(row)

    def _expire_at(self, old: int | None, ts: int) -> None:
        if self.expire_ms is not None:
            if old is not None:
                self.handle.deleteTimer(old * 1000 + self.expire_ms)
            self.handle.registerTimer(ts * 1000 + self.expire_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for num, opt, ts in zip(initialState["num"], initialState["opt"], initialState["last_update_ts"]):
            self.entry.update((list(num), list(opt), int(ts)))
            self._expire_at(None, int(ts))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        there = self.entry.get() if self.entry.exists() else None
        if there is None and self.first is None:
            for _ in rows:  # all of them are read, none is kept
                pass
            return
        num, opt, old = (np.array(there[0]), np.array(there[1]), there[2]) if there is not None else (np.array(self.first), np.zeros(0), None)
        grad, ts = np.zeros(len(num)), old if old is not None else 0
        for frame in rows:
            grad += self.gradient(num, frame)
            ts = max(ts, int(frame["ts"].max()))
        num, opt = self.rule(num, opt, grad)
        self._expire_at(old, ts)
        yield self._keep(key, num, opt, ts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.entry.exists():
            num, opt, ts = self.entry.get()
            if ts * 1000 + self.expire_ms <= expiredTimerInfo.getExpiryTimeInMs():
                yield self._keep(key, np.array(num), np.array(opt), ts, gone=True)

    def close(self) -> None:
        pass


def combined(rows: DataFrame, sums: Sequence[str], newest: Sequence[str] = ("ts",)) -> DataFrame:
    """``(table, fid, newest…, sums…)``: the rows of an id in one Arrow batch as one row, for gradients that use their rows only by the sums of
    ``sums``. It comes before the shuffle to the state, so a hot id sends a row per batch, not all its rows. Columns of ``newest`` keep
    their maximum; of a watermark set on one of them after this, a late row is spared by a newer one of its id in its batch."""
    cols = ["table", "fid", *newest, *sums]
    src = rows.select("table", "fid", *newest, *[F.col(c).cast("double").alias(c) for c in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["table", "fid"], use_threads=False).aggregate([*[(c, "max") for c in newest], *[(c, "sum") for c in sums]])
            names = ["table", "fid", *[f"{c}_max" for c in newest], *[f"{c}_sum" for c in sums]]
            yield from t.select(names).rename_columns(cols).to_batches()

    return src.mapInArrow(run, src.schema)


def stream_table(rows: DataFrame, gradient: Gradient, rule: Rule, table: DataFrame | None = None, first: list[float] | None = None,
                 expire_seconds: int | None = None) -> DataFrame:
    """The changes of a table by a stream ``(table, fid, ts, …)``: one row for each id that a micro-batch updates, and one with
    ``gone`` for each entry that expires. ``table`` (``table, fid, num, last_update_ts`` and, if it has been trained, ``opt``) is what it holds
    at the start.

    Gradients of an id in one micro-batch are added, then applied once. With ``expire_seconds`` the stream needs a watermark; an entry
    goes when the watermark has passed its last update by so much. Ids that ``table`` does not hold begin with ``first``."""
    processor = TableProcessor(gradient, rule, first, None if expire_seconds is None else expire_seconds * 1000)
    start = None
    if table is not None:
        opt = F.col("opt").cast("array<double>") if "opt" in table.columns else F.array().cast("array<double>")
        start = table.select("table", "fid", F.col("num").cast("array<double>").alias("num"), opt.alias("opt"),
                             F.coalesce("last_update_ts", F.lit(0)).cast("bigint").alias("last_update_ts")).groupBy("table", "fid")
    mode = "None" if expire_seconds is None else "EventTime"
    return rows.groupBy("table", "fid").transformWithStateInPandas(processor, CHANGES, "Append" if mode == "EventTime" else "Update", mode, initialState=start)


def state_table(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``table, fid, num, opt, last_update_ts`` of all entries after the last finished batch, or after ``batch``."""
    r = spark.read.format("statestore").option("stateVarName", "entry")
    if batch is not None:
        r = r.option("batchId", batch)
    return r.load(checkpoint).select("key.*", "value.*")


def latest_changes(changes: DataFrame, order: str = "last_update_ts") -> DataFrame:
    """The newest state of each id among the changes of several batches, without those that are gone: what a serving copy applies."""
    last = changes.groupBy("table", "fid").agg(F.max_by(F.struct("num", "last_update_ts", "gone"), F.struct(order, "gone")).alias("e"))
    return last.filter("not e.gone").select("table", "fid", "e.num", "e.last_update_ts")
