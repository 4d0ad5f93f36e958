"""Streams give the batch result, over several micro-batches, restarts and repeated batches."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sampleloom.operators import tables as E
from sampleloom.operators.admission import occurrence_admission, slot_threshold
from sampleloom.plans import bindings as bind
from sampleloom.sources.table_store import TableStore
from sampleloom.streaming import flows as S
from sampleloom.streaming import state as ST
from sampleloom.streaming import updates as UP

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Events cut into four files in time order."""
    path = str(tmp_path_factory.mktemp("events") / "in")
    ev = bind.read(spark, SF, "events")
    for i in range(4):
        ev.filter((F.col("event_id") >= i * 250) & (F.col("event_id") < (i + 1) * 250 if i < 3 else F.lit(True))).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, per=1):
    return S.file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=per)


def ids_of(df):
    return bind.samples_of(df).select("sample_id", "req_time", F.get("f_item", F.lit(0)).alias("fid"))


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_admission_over_batches(spark, parts, tmp_path):
    t = slot_threshold({200: 3})
    want = rows(occurrence_admission(ids_of(spark.read.parquet(parts)), ["req_time", "sample_id"], {200: 3}).select("fid", "sample_id", "admitted"))
    S.run_available(ST.stream_admission(ids_of(stream(spark, parts)), t), str(tmp_path / "c1"), path=str(tmp_path / "o1"))
    assert rows(spark.read.parquet(str(tmp_path / "o1"))) == want
    counts = TableStore(spark, str(tmp_path / "counts"))
    counts.commit(spark.createDataFrame([], "fid bigint, cnt bigint"))
    fn = UP.admission_writer(counts, t, 3, str(tmp_path / "o2"))
    S.run_available(ids_of(stream(spark, parts)), str(tmp_path / "c2"), fn)
    assert counts.pointer() == {"version": 4, "batch": 3}
    assert rows(spark.read.parquet(str(tmp_path / "o2")).select("fid", "sample_id", "admitted")) == want


def _gradients(batch, table):
    s = ids_of(batch).select(F.lit("item").alias("table"), "fid")
    return s.join(table.select("table", "fid", "num"), ["table", "fid"]).select("table", "fid", F.transform("num", lambda x: x * 0.1).alias("grad"))


def test_update_restart_and_repeated_batch(spark, parts, tmp_path):
    seg = [E.Segment(bind.DIM, "sgd", (("learning_rate", 0.1),))]
    start = E.with_empty_state(bind.emb(spark, SF), seg)

    def make(name):
        st = TableStore(spark, str(tmp_path / name))
        st.commit(start)
        return st

    whole, cut = make("whole"), make("cut")
    S.run_available(stream(spark, parts), str(tmp_path / "cw"), UP.update_writer(whole, _gradients, seg))
    step, seen = UP.update_writer(cut, _gradients, seg), []

    def fails_once(batch, batch_id):
        step(batch, batch_id)
        seen.append(batch_id)
        if batch_id == 1 and seen.count(1) == 1:
            raise RuntimeError("lost after commit")

    with pytest.raises(Exception):
        S.run_available(stream(spark, parts), str(tmp_path / "cc"), fails_once)
    S.run_available(stream(spark, parts), str(tmp_path / "cc"), fails_once)
    assert seen.count(1) == 2 and cut.pointer() == {"version": 4, "batch": 3}
    a, b = ({r["fid"]: r["num"] for r in st.current().collect()} for st in (whole, cut))
    assert a.keys() == b.keys() and all(abs(x - y) < 1e-12 for k in a for x, y in zip(a[k], b[k]))


def _pool_by_hand(rows_in, neg, start, most):
    queue, stat, out = [], {}, []
    for sid, _, item, pos, cached in rows_in:
        if cached:
            if item not in stat:
                queue.append(item)
                stat[item] = 0
            if len(queue) > most:
                del stat[queue.pop(0)]
        if pos and len(queue) > start:
            for k in range(neg):
                at = int(hashlib.md5(f"{sid}|{k}|item".encode()).hexdigest()[:8], 16) % len(queue)
                stat[queue[at]] += 1
                out.append((sid, k, queue[at], 1 / stat[queue[at]], (at + 1) / len(queue)))
    return out


def test_pool_evicts_and_readmits(spark, tmp_path):
    """Exact queue over several files, with a capacity small enough that items leave and return."""
    rnd = random.Random(4)
    data = [(i, 100 + i, rnd.randrange(12), rnd.random() < 0.6, rnd.random() < 0.8) for i in range(300)]
    path = str(tmp_path / "in")
    schema = "sample_id bigint, req_time bigint, item_id bigint, positive boolean, cached boolean"
    for i in range(0, 300, 100):
        df = spark.createDataFrame(data[i:i + 100], schema).withColumn("payload", F.col("item_id").cast("string")).withColumn("chan", F.lit(1))
        df.coalesce(1).write.mode("append").parquet(path)
    drawn = ST.stream_negatives(stream(spark, path), 2, 2, 5, "chan")
    S.run_available(drawn, str(tmp_path / "c"), path=str(tmp_path / "o"))
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).orderBy("sample_id", "k").select("sample_id", "k", "drawn_item", "freq", "time_factor").collect()]
    assert got == sorted(_pool_by_hand(data, 2, 2, 5))


def test_flow_writer_is_repeatable(spark, tmp_path):
    from sampleloom.functions.fid import data_source_key

    df = bind.samples(spark, SF).select("sample_id", data_source_key("device_type").alias("data_source_key"))
    fn = S.flow_writer(["pc"], str(tmp_path / "f"))
    fn(df, 0)
    fn(df, 0)
    assert spark.read.parquet(str(tmp_path / "f")).count() == bind.samples(spark, SF).filter("device_type = 'pc'").count()


def test_short_batches_wait_and_are_not_lost(spark, tmp_path):
    calls = []

    def make():
        return S.MinRows(spark, 5, lambda b, i: calls.append((i, sorted(r[0] for r in b.collect()))), str(tmp_path / "held"))

    guard = make()
    guard(spark.range(3), 0)
    guard(spark.range(3, 4), 1)
    assert calls == []
    guard = make()  # after a restart
    guard(spark.range(4, 6), 2)
    guard(spark.range(4, 6), 2)  # a batch that is run again is a short one by now, and waits
    assert calls == [(2, list(range(6)))]
    guard(spark.range(6, 8), 3)
    assert guard.flush(3) and not guard.flush(3) and calls[1:] == [(3, [6, 7])]


def test_counters_over_many_batches(spark, tmp_path):
    fn = S.counting({"top": F.max("id")}, str(tmp_path / "c"))
    for i in range(3):
        fn(spark.range(10 * i), i)
    fn(spark.range(20), 2)
    got = spark.read.parquet(str(tmp_path / "c")).orderBy("batch_no").select("rows", "top").collect()
    assert [tuple(r) for r in got] == [(0, None), (10, 9), (20, 19)]


def test_idle_stop_does_not_cut_a_running_batch(spark, parts, tmp_path):
    import time

    def slow(batch, batch_id):
        time.sleep(2.5)
        batch.write.mode("overwrite").parquet(str(tmp_path / "o" / f"batch={batch_id}"))

    q = stream(spark, parts, 2).writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").foreachBatch(slow).start()
    S.stop_when_idle(q, 1.0, 0.25)
    assert spark.read.parquet(str(tmp_path / "o")).count() == spark.read.parquet(parts).count()


def test_update_and_expiry_in_one_commit(spark, tmp_path):
    seg = [E.Segment(2, "sgd", (("learning_rate", 1.0),))]
    rows = [("t", 1, [1.0, 1.0], 100 * 86400), ("t", 2, [2.0, 2.0], 1)]
    st = TableStore(spark, str(tmp_path / "t"))
    st.commit(E.with_empty_state(spark.createDataFrame(rows, "table string, fid bigint, num array<double>, last_update_ts bigint"), seg))
    grads = lambda b, t: b.select(F.lit("t").alias("table"), "fid", F.array(F.lit(1.0), F.lit(1.0)).alias("grad"))
    batch = spark.createDataFrame([(1,)], "fid bigint")
    keep_time = UP.Step(lambda t, b, i: t.withColumn("last_update_ts", F.when(F.col("fid") == 1, F.lit(100 * 86400)).otherwise(F.col("last_update_ts"))))
    UP.table_writer(st, UP.gradient_step(grads, seg), keep_time, UP.expiry_step(1, {}, 30))(batch, 0)
    assert [(r.fid, r.num) for r in st.current().collect()] == [(1, [0.0, 0.0])] and st.pointer() == {"version": 1, "batch": 0}


def test_one_id_touches_one_bucket(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "b"), buckets=8)
    st.commit(spark.range(200).select(F.col("id").alias("fid"), F.lit(0).alias("n")))
    one = spark.createDataFrame([(5,)], "fid bigint")
    hit = st.touched(one)
    assert len(hit) == 1
    part = st.part(hit)
    assert {f.split("_bucket=")[1].split("/")[0] for f in part.inputFiles()} == {str(hit[0])}
    before = st._latest()["buckets"]
    st.commit(part.withColumn("n", F.when(F.col("fid") == 5, 1).otherwise(F.col("n"))), 0, hit)
    after = st._latest()["buckets"]
    assert {b for b in before if before[b] != after[b]} == {str(hit[0])}
    assert st.current().count() == 200 and st.current().where("n = 1").count() == 1
    with pytest.raises(Exception):
        st.commit(st.current(), 1, hit)  # rows of other buckets


def test_second_writer_fails_and_old_versions_go(spark, tmp_path):
    import os

    from sampleloom.sources.table_store import Conflict

    a = TableStore(spark, str(tmp_path / "w"), keep=2)
    a.commit(spark.range(5).select(F.col("id").alias("fid")))
    stale = a._latest()
    a.commit(spark.range(6).select(F.col("id").alias("fid")))
    b = TableStore(spark, str(tmp_path / "w"))
    b._latest = lambda: stale
    with pytest.raises(Conflict):
        b.commit(spark.range(7).select(F.col("id").alias("fid")))
    for i in range(4):
        a.commit(spark.range(i + 1).select(F.col("id").alias("fid")))
    assert a.current().count() == 4 and len([f for f in os.listdir(tmp_path / "w/pointer") if f.isdigit()]) == 2


def test_idle_stop_and_metrics(spark, parts, tmp_path):
    df = S.observed(stream(spark, parts), "m", {"top": F.max("event_id")})
    q = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start(str(tmp_path / "o"))
    q.processAllAvailable()
    assert S.stop_when_idle(q, 0.4, 0.2) >= 2 and not q.isActive
    t = [x for x in S.throughput(q) if x["rows"]]
    assert [x["batch"] for x in t] == [0, 1, 2, 3] and sum(x["observed"]["m"]["rows"] for x in t) == spark.read.parquet(parts).count()


def test_evict_every(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "e"))
    st.commit(bind.emb(spark, SF).drop("opt"))
    fn = UP.evict_every(st, 2, {200: 3})
    fn(None, 0)
    assert st.pointer()["version"] == 0
    fn(None, 1)
    assert st.pointer() == {"version": 1, "batch": 1} and st.current().count() < bind.emb(spark, SF).count()


def test_chain_runs_all(spark):
    seen = []
    S_fn = UP.chain(lambda b, i: seen.append(("a", b.count())), lambda b, i: seen.append(("b", b.count())))
    S_fn(spark.range(3), 0)
    assert seen == [("a", 3), ("b", 3)]
