"""Stateful operators: item pools and id counts kept in the state store.

Both need the RocksDB state store provider (see :data:`STATE_CONF`).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sampleloom.functions.base import u32

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """The state store settings for the time of one run. ``partitions`` is the number of state partitions, each a store of
    its own; it stays fixed in the query's checkpoint, so choose it for the life of the query (default: the session's
    shuffle partitions)."""
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = {**STATE_CONF, "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: Rows of draws that are given back at once, and rows of a micro-batch that are plain Python values at once.
GIVEN_ROWS = 1 << 16
READ_ROWS = 1 << 14


def _in_time_order(rows: Iterator[pd.DataFrame], draws: int) -> Iterator[tuple]:
    """The rows of a pool by time and sample. They are held as flat numbers, and each different payload once: some 60 bytes a row
    while payloads repeat."""
    flat = ("req_time", "sample_id", "item_id", "positive", "cached")
    parts: dict[str, list[np.ndarray]] = {c: [] for c in (*flat, "payload", "draws")}
    codes: dict[str | None, int] = {}
    for frame in rows:
        for c in flat:
            parts[c].append(frame[c].to_numpy())
        parts["payload"].append(np.fromiter((codes.setdefault(p, len(codes)) for p in frame["payload"]), np.int32, len(frame)))
        parts["draws"].append(np.array(frame["draws"].tolist(), np.int64).reshape(len(frame), draws))
    held = {}
    for c in list(parts):
        held[c] = np.concatenate(parts.pop(c)) if parts[c] else np.zeros(0)
    payloads = list(codes)
    by = np.lexsort((held["sample_id"], held.pop("req_time")))
    for i in range(0, len(by), READ_ROWS):
        some = by[i:i + READ_ROWS]
        cols = [held[c][some].tolist() for c in ("sample_id", "item_id", "positive", "cached", "payload", "draws")]
        cols[4] = [payloads[n] for n in cols[4]]
        yield from zip(*cols)


def _drawn(made: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(made, columns=["sample_id", "k", "drawn_item", "payload", "freq", "time_factor"]).astype(
        {"sample_id": "int64", "k": "int32", "drawn_item": "int64", "freq": "float64", "time_factor": "float64"})


class PoolProcessor(StatefulProcessor):
    """Exact FIFO pool of one channel: items enter at first sight, the oldest leaves beyond the
    capacity and may come back later. State holds at most ``max_item_num`` items."""

    def __init__(self, neg_num: int, start_num: int, max_item_num: int) -> None:
        self.neg_num, self.start_num, self.max_item_num = neg_num, start_num, max_item_num

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "head bigint, tail bigint")
        self.order = handle.getMapState("order", "seq bigint", "item bigint")
        self.items = handle.getMapState("items", "item bigint", "payload string, origin_cnt bigint, sample_cnt bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        head, tail = self.ends.get() if self.ends.exists() else (None, None)
        for seq, item, payload, origin, drawn in zip(*[initialState[c] for c in ("seq", "item", "payload", "origin_cnt", "sample_cnt")]):
            self.order.updateValue((int(seq),), (int(item),))
            self.items.updateValue((int(item),), (payload, int(origin), int(drawn)))
            head = int(seq) if head is None else min(head, int(seq))
            tail = int(seq) + 1 if tail is None else max(tail, int(seq) + 1)
        if head is not None:
            self.ends.update((head, tail))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        head, tail = self.ends.get() if self.ends.exists() else (0, 0)
        order: dict[int, int] = {}
        items: dict[int, list | None] = {}

        def item(i: int) -> list | None:
            if i not in items:
                items[i] = list(self.items.getValue((i,))) if self.items.containsKey((i,)) else None
            return items[i]

        def at(seq: int) -> int:
            if seq not in order:
                order[seq] = self.order.getValue((seq,))[0]
            return order[seq]

        dropped: set[int] = set()
        made: list[tuple] = []
        for sample_id, item_id, positive, cached, payload, draws in _in_time_order(rows, self.neg_num):
            if cached:
                known = item(item_id)
                if known is not None:
                    known[1] += 1
                else:
                    items[item_id] = [payload, 1, 0]
                    order[tail] = item_id
                    dropped.discard(item_id)
                    tail += 1
                if tail - head > self.max_item_num:
                    old = at(head)
                    items[old] = None
                    dropped.add(old)
                    order[head] = None
                    head += 1
            size = tail - head
            if not positive or size <= self.start_num:
                continue
            for k in range(self.neg_num):
                place = int(draws[k]) % size
                i = at(head + place)
                hit = item(i)
                hit[2] += 1
                made.append((sample_id, k, i, hit[0], 1.0 / hit[2], (place + 1.0) / size))
            if len(made) >= GIVEN_ROWS:
                yield _drawn(made)
                made = []

        for seq, i in order.items():
            if i is None:
                if self.order.containsKey((seq,)):
                    self.order.removeKey((seq,))
            else:
                self.order.updateValue((seq,), (i,))
        for i, v in items.items():
            if v is not None:
                self.items.updateValue((i,), tuple(v))
            elif i in dropped and self.items.containsKey((i,)):
                self.items.removeKey((i,))
        self.ends.update((head, tail))
        yield _drawn(made)

    def close(self) -> None:
        pass


NEGATIVE_SCHEMA = "sample_id bigint, k int, drawn_item bigint, payload string, freq double, time_factor double"


def stream_negatives(rows: DataFrame, neg_num: int, start_num: int, max_item_num: int, channel: str,
                     sub_pools: int = 1, pools: DataFrame | None = None) -> DataFrame:
    """Draws for the positives of a stream of ``(sample_id, req_time, item_id, positive, cached,
    payload, channel)``. ``sub_pools`` > 1 cuts each channel into independent pools by sample, for
    channels too big for one task; a pool then sees only its share of the items. ``pools`` (see :func:`state_pools`, with as many
    ``sub_pools``) are the pools of an earlier query, with which this one goes on."""
    random = F.array(*[u32(F.concat_ws("|", "sample_id", F.lit(k), F.lit("item"))) for k in range(neg_num)]).cast("array<bigint>")
    rows = rows.withColumn("_sub", F.pmod(F.xxhash64("sample_id"), F.lit(sub_pools))).withColumn("draws", random)
    kept = pools.groupBy(channel, "_sub") if pools is not None else None
    return rows.groupBy(channel, "_sub").transformWithStateInPandas(
        PoolProcessor(neg_num, start_num, max_item_num), NEGATIVE_SCHEMA, "Append", "None", initialState=kept)


def state_pools(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(channel, _sub, seq, item, payload, origin_cnt, sample_cnt)``: the pools that a :func:`stream_negatives` query holds after its
    last finished batch, the channel under its own name."""
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    order = read("order").select("key.*", F.col("user_map_key.seq").alias("seq"), F.col("user_map_value.item").alias("item"))
    items = read("items").select("key.*", F.col("user_map_key.item").alias("item"), "user_map_value.*")
    return order.join(items, [*[c for c in order.columns if c not in ("seq", "item")], "item"])


class AdmissionProcessor(StatefulProcessor):
    """Occurrences of one id so far, forgotten ``ttl`` after the last one."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        batch = pd.concat(list(rows)).sort_values(["req_time", "sample_id"])
        before = n + pd.RangeIndex(len(batch)).to_numpy()
        self.count.update((int(n + len(batch)),))
        yield pd.DataFrame({"fid": [key[0]] * len(batch), "sample_id": batch["sample_id"].to_numpy(),
                            "admitted": before >= batch["threshold"].to_numpy()})

    def close(self) -> None:
        pass


def stream_admission(rows: DataFrame, threshold: Column, ttl_ms: int | None = None) -> DataFrame:
    """``(fid, sample_id, admitted)`` of a stream ``(sample_id, req_time, fid)``."""
    src = rows.select("fid", "sample_id", "req_time", threshold.cast("bigint").alias("threshold"))
    return src.groupBy("fid").transformWithStateInPandas(
        AdmissionProcessor(ttl_ms), "fid bigint, sample_id bigint, admitted boolean", "Append",
        "ProcessingTime" if ttl_ms else "None")


class TouchedProcessor(StatefulProcessor):
    """Ids of one set since it was last emptied. A set that holds more than its capacity is cleared before the next id
    enters; a row that asks to steal gives all ids and empties the set."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getMapState("ids", "fid bigint", "there boolean")
        self.size = handle.getValueState("size", "n bigint, dropped bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        size, dropped = self.size.get() if self.size.exists() else (0, 0)
        for frame in rows:  # one frame at a time, in the order of arrival
            for fid, steal in zip(frame["fid"].tolist(), frame["steal"].tolist()):
                if steal:
                    given = [k[0] for k in self.ids.keys()]
                    yield pd.DataFrame({"set": key[0], "fid": given, "dropped": dropped}).astype({"set": "int64", "fid": "int64", "dropped": "int64"})
                    self.ids.clear()
                    size, dropped = 0, 0
                    continue
                if size > self.capacity:
                    dropped += size
                    self.ids.clear()
                    size = 0
                if not self.ids.containsKey((fid,)):
                    self.ids.updateValue((fid,), (True,))
                    size += 1
        self.size.update((size, dropped))

    def close(self) -> None:
        pass


def stream_touched(rows: DataFrame, capacity: int) -> DataFrame:
    """``(set, fid, dropped)`` at each row of the stream ``(set, fid, steal)`` that asks to steal: the ids of its set and how many
    were cleared since the last time. Each set (a shard of a table) has its own state of at most ``capacity`` + 1 ids."""
    return rows.groupBy("set").transformWithStateInPandas(
        TouchedProcessor(capacity), "set bigint, fid bigint, dropped bigint", "Append", "None")


def windowed_counts(rows: DataFrame, ts: str, window: str, slide: str, late: str) -> DataFrame:
    """Occurrences per id and sliding event-time window, with bounded state: late rows beyond the
    watermark are dropped, as the window has been emitted."""
    return (rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
            .groupBy(F.window("_ts", window, slide), "fid").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.col("window.start").alias("start"), "fid", "cnt"))
