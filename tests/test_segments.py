"""Segments by distinct ids, the admission ring, touched sets and queues over chunks, against plain folds."""

import random

import pytest
from pyspark.sql import functions as F

from sampleloom.operators import admission as A
from sampleloom.operators import negatives as N
from sampleloom.operators.segments import distinct_segments


def folded(ids, distinct):
    out, seen, g = [], set(), 0
    for x in ids:
        seen.add(x)
        out.append(g)
        if len(seen) == distinct:
            g, seen = g + 1, set()
    return out


def stream(seed, n, kinds, nulls=0.1, hot=0.0):
    rnd = random.Random(seed)
    return [None if rnd.random() < nulls else 0 if rnd.random() < hot else rnd.randrange(kinds) for _ in range(n)]


@pytest.mark.parametrize("n,kinds,distinct,chunk,group,hot", [
    (300, 20, 5, 16, 2, 0.0), (300, 10 ** 6, 7, 16, 3, 0.0), (200, 3, 5, 16, 2, 0.0), (400, 60, 25, 10, 2, 0.6), (40, 9, 1, 8, 4, 0.0)])
def test_segments(spark, n, kinds, distinct, chunk, group, hot):
    ids = stream(n, n, kinds, hot=hot)
    df = spark.createDataFrame(list(enumerate(ids)), "t long, fid long").repartition(5)
    got = distinct_segments(df, [F.col("t")], distinct, chunk=chunk, group=group).orderBy("t").collect()
    assert [r.segment for r in got] == folded(ids, distinct) and [r.fid for r in got] == ids


def test_segments_of_nothing(spark):
    assert distinct_segments(spark.createDataFrame([], "t long, fid long"), [F.col("t")], 3).count() == 0
    with pytest.raises(ValueError):
        distinct_segments(spark.createDataFrame([(1, 1)], "t long, fid long"), [F.col("t")], 0)


class Ring:
    """The ring as it runs: a dict per split, counts that stop at fifteen."""

    def __init__(self, distinct, back):
        self.distinct, self.back, self.splits = distinct, back, [{}]

    def add(self, fid):
        head = self.splits[-1]
        if fid in head:
            old = head[fid]
        else:
            old = next((s[fid] for s in self.splits[-2:-2 - self.back:-1] if fid in s), 0)
        head[fid] = min(15, old + 1)
        if len(head) == self.distinct:
            self.splits.append({})
        return old


@pytest.mark.parametrize("distinct,back,hot", [(4, 2, 0.0), (6, 3, 0.5), (50, 3, 0.0)])
def test_ring(spark, distinct, back, hot):
    ids = stream(distinct, 300, 30, nulls=0, hot=hot)
    ring = Ring(distinct, back)
    want = [ring.add(x) for x in ids]
    v2 = lambda x: (200 << 48) + x
    df = spark.createDataFrame([(i, v2(x)) for i, x in enumerate(ids)] + [(500, (5 << 48) + 1)], "t long, fid long").repartition(4)
    out = A.ring_admission(df, ["t"], distinct, back, {200: 3}, chunk=32, group=2)
    rows = sorted(out.collect(), key=lambda r: r.t)
    assert [r.admitted for r in rows[:-1]] == [n >= 3 for n in want] and rows[-1].admitted and rows[-1].split is None
    state = {r.fid: (r.age, r.cnt) for r in A.ring_state(out, distinct, back).collect()}
    live = {}
    for age, split in enumerate(ring.splits[::-1]):
        for x, n in split.items():
            if age <= back:
                live.setdefault(v2(x), (age, n))
    assert state == live
    assert not any(r.admitted for r in A.ring_admission(df.filter("t < 500"), ["t"], distinct, back, {200: 16}, chunk=32, group=2).collect())


def test_ring_of_heavy_ids(spark):
    """Ids with many rows are counted by joins, others by windows: the same rows."""
    ids = stream(9, 300, 30, nulls=0, hot=0.5)
    ring = Ring(6, 3)
    want = [ring.add(x) for x in ids]
    df = spark.createDataFrame([(i, (200 << 48) + x) for i, x in enumerate(ids)], "t long, fid long").repartition(4)
    for hot_rows in (5, 1000):
        rows = sorted(A.ring_admission(df, ["t"], 6, 3, {200: 3}, hot_rows=hot_rows, chunk=32, group=2).collect(), key=lambda r: r.t)
        assert [r.admitted for r in rows] == [n >= 3 for n in want]
        assert [r.split for r in rows] == folded(ids, 6)


def test_jobs_do_not_grow_with_the_stream(spark):
    def jobs(n):
        sc = spark.sparkContext
        sc.setJobGroup(f"ring{n}", "")
        df = spark.range(n).selectExpr("id as t", f"({200 << 48} + id * 7919 % 61) as fid")
        got = A.ring_admission(df, ["t"], 24, 3, {200: 2}, chunk=16).orderBy("t").collect()
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert [r.split for r in got] == folded([r.fid for r in got], 24)
        return len(sc.statusTracker().getJobIdsForGroup(f"ring{n}"))

    assert jobs(12_000) <= jobs(2_000) + 5  # 12 groups of 64 chunks and 2


def test_ring_goes_on_from_a_save(spark, tmp_path):
    ids = stream(5, 240, 25, nulls=0)
    df = spark.createDataFrame([(i, (200 << 48) + x) for i, x in enumerate(ids)], "t long, fid long")
    whole = {r.t: r.admitted for r in A.ring_admission(df, ["t"], 8, 2, {200: 2}, chunk=32, group=2).collect()}
    one = A.ring_splits(df.filter("t < 101"), ["t"], 8)
    A.save_counts(A.ring_state(one, 8, 2), str(tmp_path / "ring"), 3)
    state = A.restore_counts(spark, [str(tmp_path / "ring")])
    rest = A.ring_admission(df.filter("t >= 101"), ["t"], 8, 2, {200: 2}, state=state, chunk=32, group=2)
    assert {r.t: r.admitted for r in rest.collect()} == {t: a for t, a in whole.items() if t >= 101}


def test_ring_size():
    assert A.ring_size(1_000_000, 10) == (1_000_000 // 9 - 1, 8) and A.ring_size(1, 1) == (74, 3)


def test_saves_are_added_and_stop(spark):
    a = spark.createDataFrame([(1, 9), (2, 3)], "fid long, cnt long")
    b = spark.createDataFrame([(1, 9), (3, 1)], "fid long, cnt long")
    assert {r.fid: r.cnt for r in A.merged_counts([a, b]).collect()} == {1: 15, 2: 3, 3: 1}


@pytest.mark.parametrize("n,dropped,left", [(1000, 0, range(1000)), (1005, 1001, range(1001, 1005)), (1001, 0, range(1001))])
def test_touched_set(spark, n, dropped, left):
    df = spark.range(n).select(F.col("id").alias("fid"))
    rows = A.touched_set(df, ["fid"], 1000, chunk=256, group=2).collect()
    assert sorted(r.fid for r in rows) == list(left) and {r.dropped for r in rows} == {dropped}


@pytest.mark.parametrize("items,capacity,chunk", [(30, 7, 40), (12, 10, 25), (200, 9, 50), (8, 9, 50)])
def test_queue_over_chunks(spark, items, capacity, chunk):
    rnd = random.Random(items)
    rows = [(rnd.choice([None, 1, 1, 1, 2]), i // 2, i, rnd.randrange(items)) for i in range(500)]
    df = spark.createDataFrame(rows, "_ch long, req_time long, sample_id long, _item long").repartition(4)
    want = sorted(map(tuple, N.queue_entries(df, capacity).collect()), key=str)
    assert sorted(map(tuple, N.queue_chunks(df, capacity, chunk, largest=500).collect()), key=str) == want


def test_hot_channel_is_read_by_many_tasks(spark):
    """A channel with all rows: the same pool as in one task, and a chunk for each of many tasks."""
    df = spark.range(6000).selectExpr("7L as _ch", "id as req_time", "id as sample_id", "(id * 7919) % 61 as _item")
    one = N.item_pool(df, capacity=40, largest=6000)
    many = N.item_pool(df, capacity=40, largest=6000, chunk_rows=500)
    key = ["_ch", "_item", "seq", "origin_cnt", "first_at"]
    assert sorted(map(str, one.select(*key).collect())) == sorted(map(str, many.select(*key).collect()))
