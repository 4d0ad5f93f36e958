"""Tables, pools and touched sets kept in the state of a stream: restarts, deltas, expiry, initial states."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sampleloom.streaming import flows as S
from sampleloom.streaming import keyed_tables as K
from sampleloom.streaming import state as ST

ROWS = "table string, fid bigint, ts bigint, d double"


def write(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return S.file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)


def batches(path):
    def each(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return each


def entries(spark, path, batch=None):
    return {r.fid: (r.num, r.last_update_ts) for r in K.state_table(spark, path, batch).collect()}


def test_table_restart_deltas_and_one_id_batches(spark, tmp_path):
    base = str(tmp_path)
    table = spark.createDataFrame([("t", i, [1.0 * i, 2.0], 5) for i in range(50)], "table string, fid bigint, num array<double>, last_update_ts bigint")
    given = [[("t", 1, 10, 0.5), ("t", 1, 12, 0.25), ("t", 2, 11, 1.0), ("t", 99, 11, 1.0)], [("t", 2, 20, 0.5)], [("t", 7, 30, 0.1), ("t", 1, 30, 0.5)]]
    num, opt, ts = {i: np.array([1.0 * i, 2.0]) for i in range(50)}, {}, {i: 5 for i in range(50)}
    rule = K.adagrad(0.05)
    for n, rows in enumerate(given):
        write(spark, f"{base}/in", rows, ROWS)
        changes = K.stream_table(source(spark, f"{base}/in"), lambda v, f: v * f["d"].sum(), K.adagrad(0.05), table)
        S.run_available(changes, f"{base}/ckpt", batches(f"{base}/out"), mode="update")  # a new query goes on from the checkpoint
        touched = sorted({r[1] for r in rows} - {99})
        for i in touched:
            d = sum(r[3] for r in rows if r[1] == i)
            num[i], opt[i] = rule(num[i], opt.get(i, np.zeros(0)), num[i] * d)
            ts[i] = max(r[2] for r in rows if r[1] == i)
        delta = spark.read.parquet(f"{base}/out/batch={n}").collect()
        assert sorted(r.fid for r in delta) == touched  # a batch gives, reads and writes its own ids
        assert all(np.allclose(r.num, num[r.fid]) for r in delta)
    got = entries(spark, f"{base}/ckpt")
    assert set(got) == set(range(50)) and all(np.allclose(got[i][0], num[i]) and got[i][1] == ts[i] for i in range(50))
    assert entries(spark, f"{base}/ckpt", 0)[2][1] == 11  # the state of an earlier batch is still there
    latest = {r.fid: r.num for r in K.latest_changes(spark.read.parquet(f"{base}/out"), "batch").collect()}
    assert set(latest) == {1, 2, 7} and all(np.allclose(latest[i], num[i]) for i in latest)


def test_entries_expire_by_their_own_timers(spark, tmp_path):
    base = str(tmp_path)
    table = spark.createDataFrame([("t", 1, [1.0], 100), ("t", 2, [1.0], 100), ("t", 3, [1.0], 180)], "table string, fid bigint, num array<double>, last_update_ts bigint")
    for rows in ([("t", 1, 150, 1.0)], [("t", 9, 201, 1.0)], [("t", 9, 230, 1.0)]):
        write(spark, f"{base}/in", rows, ROWS)
        src = source(spark, f"{base}/in").withColumn("at", F.timestamp_seconds("ts")).withWatermark("at", "0 seconds")
        S.run_available(K.stream_table(src, lambda v, f: v * 0, K.sgd(1.0), table, [0.0], 100), f"{base}/ckpt", batches(f"{base}/out"), mode="append")
    assert {i: ts for i, (_, ts) in entries(spark, f"{base}/ckpt").items()} == {1: 150, 3: 180, 9: 230}
    gone = spark.read.parquet(f"{base}/out").filter("gone").collect()
    assert [(r.fid, r.last_update_ts) for r in gone] == [(2, 100)]


NEG = "sample_id bigint, req_time bigint, item_id bigint, positive boolean, cached boolean, payload string, chan bigint"


def test_pools_go_on_in_another_query(spark, tmp_path):
    base = str(tmp_path)
    rows = [(i, i, (i * 37) % 23, i % 2 == 0, i % 3 > 0, f"p{i}", i % 3) for i in range(240)]
    for name, part in (("a", rows[:120]), ("b", rows[120:]), ("all", rows[:120]), ("all", rows[120:])):
        write(spark, f"{base}/{name}", part, NEG)

    def draw(name, pools=None):
        out = ST.stream_negatives(source(spark, f"{base}/{name}"), 3, 4, 9, "chan", 2, pools)
        S.run_available(out, f"{base}/ckpt-{name}", path=f"{base}/out-{name}")
        return sorted(map(tuple, spark.read.parquet(f"{base}/out-{name}").collect()))

    one = draw("a")
    pools = ST.state_pools(spark, f"{base}/ckpt-a")
    pools.write.parquet(f"{base}/pools")  # saved, and given to a query with a checkpoint of its own
    two = draw("b", spark.read.parquet(f"{base}/pools"))
    assert sorted(one + two) == draw("all") and one and two


@pytest.mark.parametrize("n,dropped,left", [(40, 0, list(range(40))), (45, 41, [41, 42, 43, 44])])
def test_touched_set_is_stolen_after_a_restart(spark, tmp_path, n, dropped, left):
    base, ddl = str(tmp_path), "set bigint, fid bigint, steal boolean"
    for part in ([(1, i, False) for i in range(25)], [(1, i, False) for i in range(20, n)] + [(2, 7, False)], [(1, None, True), (2, None, True)], [(1, None, True)]):
        write(spark, f"{base}/in", part, ddl)
        S.run_available(ST.stream_touched(source(spark, f"{base}/in"), 40), f"{base}/ckpt", path=f"{base}/out")
    rows = spark.read.parquet(f"{base}/out").collect()
    assert sorted(r.fid for r in rows if r.set == 1) == left and {r.dropped for r in rows if r.set == 1} == {dropped}
    assert [(r.fid, r.dropped) for r in rows if r.set == 2] == [(7, 0)]


class _State:
    """State variables of one key without a stream."""

    def __init__(self):
        self.of = {}

    def getValueState(self, name, *_):
        return self.of.setdefault(name, _State())

    getMapState = getValueState

    def exists(self):
        return bool(self.of)

    def get(self):
        return self.of[()]

    def update(self, value):
        self.of[()] = value

    def containsKey(self, key):
        return key in self.of

    def getValue(self, key):
        return self.of[key]

    def updateValue(self, key, value):
        self.of[key] = value

    def removeKey(self, key):
        del self.of[key]


def _pool_rows(n, frames):
    rng = np.random.default_rng(3)
    for at in range(0, n, n // frames):
        k = n // frames
        yield pd.DataFrame({"req_time": rng.permutation(k) + at, "sample_id": np.arange(at, at + k), "item_id": rng.integers(0, 40, k), "positive": True,
                            "cached": True, "payload": [f"item {i}" for i in rng.integers(0, 40, k)], "draws": [np.array(d) for d in rng.integers(0, 1 << 32, (k, 3))]})


def test_pool_gives_draws_in_parts(monkeypatch):
    def run(frames):
        p = ST.PoolProcessor(3, 4, 8)
        p.init(_State())
        return list(p.handleInputRows((1, 0), frames, None))

    monkeypatch.setattr(ST, "GIVEN_ROWS", 300, raising=False)
    monkeypatch.setattr(ST, "READ_ROWS", 70, raising=False)
    parts = run(_pool_rows(1000, 4))
    assert max(map(len, parts)) <= 303 and len(parts) > 3
    whole = run(iter([pd.concat(list(_pool_rows(1000, 4)))]))
    assert pd.concat(parts).reset_index(drop=True).equals(pd.concat(whole).reset_index(drop=True))
    assert run(iter([next(_pool_rows(4, 1)).head(0)]))[0].empty


def test_combined_rows_of_an_id(spark):
    """Rows of an id leave as one row for each Arrow batch, with the same sums and newest times."""
    rows = spark.range(0, 4000, 1, 2).select(F.lit("t").alias("table"), (F.col("id") % 3).alias("fid"), F.col("id").alias("ts"),
                                             F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("d"))
    got = K.combined(rows, ["d"])
    assert got.columns == ["table", "fid", "ts", "d"] and got.count() == 6
    want = {r[0]: (r[1], r[2]) for r in rows.groupBy("fid").agg(F.max("ts"), F.sum("d").cast("double")).collect()}
    assert {r[0]: (r[1], r[2]) for r in got.groupBy("fid").agg(F.max("ts"), F.sum("d")).collect()} == want
