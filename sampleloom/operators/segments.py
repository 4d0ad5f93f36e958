"""Segments of a stream that are bounded by distinct ids: each ends with the row that brings its last allowed id.

Where a segment ends depends on where it began, so the cuts form one chain over the whole stream. No task follows it from
end to end. The stream is cut into chunks of places, held as arrays of ids; for every place of a chunk the start that
follows a segment from there is found with two pointers over the chunk and the first sights after it. From these, the
first start after the chunk, and after a group of chunks, is known for every place. The chain then hops over groups (one
number for each on the driver), and groups and chunks fill in their own cuts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleloom.operators.ordering import numbered, together
from sampleloom.session import settled

#: Places of a chunk (more if a segment needs more), and chunks of a group.
CHUNK, GROUP = 1 << 16, 64
#: Share of chunks that shall hold a whole segment's ids by themselves.
FULL_SHARE = 0.9


def following_starts(ids: np.ndarray, first: int, ahead: np.ndarray, distinct: int, none: int) -> np.ndarray:
    """For each place of a chunk that begins at ``first``: the start after a segment from there.

    ``ids`` holds the ids of the chunk's rows and then of the rows at the later places ``ahead``, ascending. ``none`` stands for a
    segment that the stream does not fill."""
    total, n = len(ids), len(ids) - len(ahead)
    places = np.concatenate([np.arange(first + 1, first + n + 1), ahead + 1]).tolist()
    same = np.argsort(ids, kind="stable")
    twin = np.flatnonzero(ids[same][1:] == ids[same][:-1])
    back, again = np.full(total, -1), np.full(total, total)  # index of the previous and of the next row with the same id
    back[same[twin + 1]], again[same[twin]] = same[twin], same[twin + 1]
    back, again, out = back.tolist(), again[:n].tolist(), []
    end = seen = 0
    for s, next_ in enumerate(again):
        while seen < distinct and end < total:
            if back[end] < s:
                seen += 1
            end += 1
        if seen < distinct:
            break
        out.append(places[end - 1])
        if next_ >= end:
            seen -= 1  # the id leaves the window unless it comes again inside
    return np.array(out + [none] * (n - len(out)), np.int64)


def after(nexts: np.ndarray, first: int) -> np.ndarray:
    """For each place of a chunk: the first start behind the chunk on the chain from there."""
    out, n = (nexts - first).tolist(), len(nexts)
    for s in range(n - 1, -1, -1):
        if out[s] < n:
            out[s] = out[out[s]]
    return np.array(out, np.int64) + first


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks()).astype(np.int64) if len(column) else np.zeros(0, np.int64)


def _lists(*rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, rows)]).astype(np.int32), np.concatenate(rows))


def _pieces(size: int) -> Callable:
    """Rows in order of place, ids of a chunk together as far as they come in one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            pos = np.asarray(b.column(0))
            cut = np.flatnonzero(np.diff((pos - 1) // size, prepend=-1))
            yield pa.RecordBatch.from_arrays([
                pa.array((pos[cut] - 1) // size), pa.array(pos[cut]), pa.ListArray.from_arrays(np.append(cut, len(pos)).astype(np.int32), b.column(1))],
                names=["_chunk", "_first", "_ids"])
    return run


def _whole(distinct: int) -> Callable:
    """The ids of a chunk from its pieces, and the first sights of the first ``distinct`` of them."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_first")
        ids = t["_ids"].combine_chunks().flatten()
        codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        sights = np.sort(np.unique(codes, return_index=True)[1])[:distinct]
        head = pa.StructArray.from_arrays([ids.take(pa.array(sights)), pa.array(sights + t["_first"][0].as_py())], ["_id", "_pos"])
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.table({"_chunk": t["_chunk"].slice(0, 1), "_ids": whole(ids), "_head": whole(head)})
    return run


def distinct_segments(df: DataFrame, order: Sequence[Column], distinct: int, fid: str = "fid", chunk: int = CHUNK, group: int = GROUP,
                      name: str = "segment") -> DataFrame:
    """``df`` with the number of each row's segment (from 0) along ``order``, a total order. A segment ends with the row that
    brings its ``distinct``-th id; the last one may hold fewer. Null ids count as one id."""
    if distinct < 1:
        raise ValueError("a segment needs at least one id")
    spark = df.sparkSession
    rows, total = numbered(df, order, "_pos")
    if not total:
        return rows.withColumn(name, F.lit(0).cast("bigint")).drop("_pos")
    none = total + 1
    size = max(chunk, 2 * distinct) if chunk == CHUNK else chunk
    kind = df.schema[fid].dataType.simpleString()
    plain = rows.select("_pos", F.col(fid).alias("_id"))
    while True:
        at = F.floor((F.col("_pos") - 1) / size).cast("bigint")
        pieces = plain.mapInArrow(_pieces(size), f"_chunk bigint, _first bigint, _ids array<{kind}>")
        packed = settled(together(pieces, "_chunk").groupBy("_chunk").applyInArrow(
            _whole(distinct), f"_chunk bigint, _ids array<{kind}>, _head array<struct<_id:{kind},_pos:bigint>>"))
        full, chunks = packed.agg(F.avg((F.size("_head") >= distinct).cast("double")), F.count(F.lit(1))).first()
        if chunks <= group or full >= FULL_SHARE:
            break
        size *= 4
    if group == GROUP:
        group = max(group, CHUNK * GROUP // size)  # small chunks: as many places as with chunks of the usual size
    # a chunk looks ahead as far as the next chunk that holds enough ids, at the first sights there
    by_chunk = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk
    counts = packed.select("_chunk", F.size("_head").alias("_ids"))
    reach = counts.select("_chunk", F.coalesce(F.max(F.when(F.col("_ids") >= distinct, F.col("_chunk"))).over(by_chunk), F.lit(0)).alias("_from"))
    by_id = Window.partitionBy("_id").orderBy("_chunk")  # at most one row per chunk
    first = packed.select("_chunk", F.inline("_head")).withColumn("_seen", F.lag("_chunk").over(by_id))
    ahead = first.join(reach, "_chunk").withColumn("_to", F.greatest("_seen", "_from"))
    looks = ahead.where("_to < _chunk").select(F.explode(F.sequence("_to", F.col("_chunk") - 1)).alias("_chunk"), "_id", "_pos")

    def starts(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a):
            return pa.table({"_chunk": pa.array([], pa.int64()), "_next": pa.array([], pa.list_(pa.int64()))})
        b = b.sort_by("_pos")
        own = a["_ids"].combine_chunks().flatten()
        ids = pa.concat_arrays([own, *b["_id"].cast(own.type).chunks]).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        got = following_starts(ids, int(a["_chunk"][0].as_py()) * size + 1, _longs(b["_pos"]), distinct, none)
        return pa.table({"_chunk": a["_chunk"], "_next": _lists(got)})

    own = together(packed.select("_chunk", "_ids"), "_chunk").groupBy("_chunk")
    nexts = settled(own.cogroup(together(looks, "_chunk").groupBy("_chunk")).applyInArrow(starts, "_chunk bigint, _next array<bigint>"))
    width = size * group

    def hop(t: pa.Table) -> pa.Table:
        """The first start behind the group for each of its places; later chunks first."""
        order_ = np.argsort(_longs(t["_chunk"]))[::-1]
        lo = int(_longs(t["_chunk"]).min()) * size + 1
        arrays = [np.asarray(t["_next"][int(k)].values) for k in order_]
        end = lo + sum(map(len, arrays))
        out = np.full(end - lo, none, np.int64)
        for k, x in zip(order_, arrays):
            f = int(t["_chunk"][int(k)].as_py()) * size + 1
            x = after(x, f)
            near = x < end
            x[near] = out[x[near] - lo]
            out[f - lo:f - lo + len(x)] = x
        return pa.table({"_group": t["_group"].slice(0, 1).combine_chunks(), "_hop": _lists(out)})

    grouped = nexts.withColumn("_group", F.floor(F.col("_chunk") / group).cast("bigint"))
    entries = [(0, 1)]
    if chunks > group:
        hops = settled(together(grouped, "_group").groupBy("_group").applyInArrow(hop, "_group bigint, _hop array<bigint>"))
        s = 1
        while True:
            g = (s - 1) // width
            s = hops.where(F.col("_group") == g).select(F.element_at("_hop", int(s - g * width))).first()[0]  # one number
            if s >= none:
                break
            entries.append(((s - 1) // width, s))

    def cuts(t: pa.Table) -> pa.Table:
        """Starts of the group's segments by chunk, on the chain from the group's first start."""
        order_ = np.argsort(_longs(t["_chunk"]))
        s, out = int(t["_start"][0].as_py()), []
        for k in order_:
            c = int(t["_chunk"][int(k)].as_py())
            x, f, mine = np.asarray(t["_next"][int(k)].values), c * size + 1, []
            while s < f + len(x):
                mine.append(s)
                s = int(x[s - f])
            if mine:
                out.append((c, mine))
        return pa.table({"_chunk": pa.array([c for c, _ in out], pa.int64()), "_starts": pa.array([m for _, m in out], pa.list_(pa.int64()))})

    begun = spark.createDataFrame(entries, "_group bigint, _start bigint")
    found = settled(grouped.join(begun, "_group").groupBy("_group").applyInArrow(cuts, "_chunk bigint, _starts array<bigint>"))
    running = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk again
    marks = counts.select("_chunk").join(found, "_chunk", "left").withColumn("_starts", F.coalesce("_starts", F.array().cast("array<bigint>")))
    marks = settled(marks.withColumn("_before", F.coalesce(F.sum(F.size("_starts")).over(running), F.lit(0))))

    # a row's number is that of the last start up to it; the chunk's earlier starts count as one before its first place
    base = marks.select("_chunk", (F.col("_chunk") * size).alias("_pos"), (F.col("_before") - 1).alias(name))
    begins = marks.select("_chunk", F.posexplode("_starts").alias("_i", "_pos"), "_before").select("_chunk", "_pos", (F.col("_before") + F.col("_i")).alias(name))
    tagged = rows.withColumn("_chunk", at).withColumn("_row", F.lit(True))
    both = tagged.unionByName(base.unionByName(begins), allowMissingColumns=True)
    w = Window.partitionBy("_chunk").orderBy("_pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # at most one chunk of rows
    return both.withColumn(name, F.max(name).over(w)).where("_row").select(*df.columns, F.col(name).cast("bigint"))
