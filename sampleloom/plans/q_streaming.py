"""Streaming jobs over the event file, each compared with its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import labels as L
from sampleloom.functions import predicates as P
from sampleloom.functions.fid import data_source_key
from sampleloom.functions.numeric import sigmoid
from sampleloom.operators import negatives as N
from sampleloom.operators import tables as E
from sampleloom.operators.admission import slot_threshold
from sampleloom.operators.joins import lookup_join
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import DIM, EMB, GRADS, SAMPLES, read, w
from sampleloom.plans.q_negatives import CFG, _pool, wr
from sampleloom.plans.q_tables import NOW, _show, _step_sql
from sampleloom.plans.registry import INV, labs, query, r6, s_labs, s_r6, s_vec, vec
from sampleloom.sources.table_store import TableStore
from sampleloom.streaming import flows as S
from sampleloom.streaming import keyed_tables as K
from sampleloom.streaming import state as ST
from sampleloom.streaming import updates as UP


#: State partitions of the stateful queries here: two for each of eight cores.
STATE_PARTS = 16


def _events(spark, d):
    return S.file_stream(spark, d, read(spark, d, "events").schema, "events.parquet")


def _samples(spark, d):
    return bind.samples_of(_events(spark, d))


def _run(spark, name, df, each_batch=None):
    """Run to the end of the input; returns the sink folder."""
    base = S.work_dir(spark, name)
    S.run_available(df, f"{base}/ckpt", each_batch, f"{base}/out")
    return f"{base}/out"


def _seed(spark, name, df):
    store = TableStore(spark, S.work_dir(spark, name))
    store.commit(df)
    return store


@query("stream_samples", w(SAMPLES) + f"""
SELECT sample_id, {s_labs(f"[CASE WHEN label[1] <= 0 THEN {INV} ELSE label[1] END, label[2], CASE WHEN actions[1] = 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END]")} AS label
FROM samples WHERE actions[1] IN (1, 2, 4) AND (label[1] >= 1 OR label[2] >= 0.2::DOUBLE)""")
def _(spark, d):
    s = _samples(spark, d).filter(P.any_action("actions", [1, 2, 4]) & P.by_label("label", [1.0, 0.2]))
    out = s.select("sample_id", labs(L.add_label("sample_id", "label", "actions", "4::1.0")).alias("label"))
    return spark.read.parquet(_run(spark, "samples", out))


@query("discover_files", "SELECT event_id, event_type FROM events")
def _(spark, d):
    df = S.file_stream(spark, d, read(spark, d, "events").schema, "events*.parquet", files_per_trigger=1)
    return spark.read.parquet(_run(spark, "files", df.select("event_id", "event_type")))


@query("stream_idle_stop", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    base = S.work_dir(spark, "idle")
    q = (_events(spark, d).select("event_id", "event_type").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").trigger(processingTime="200 milliseconds").start(f"{base}/out"))
    q.processAllAvailable()
    S.stop_when_idle(q, 0.6, 0.3)
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("min_batch_guard", "SELECT event_id FROM events")
def _(spark, d):
    base = S.work_dir(spark, "guard")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    # two files of the same events, one of them short: its rows wait for the other file's, or for the end
    ev = read(spark, d, "events").select("event_id")
    ev.orderBy("event_id").limit(5).coalesce(1).write.parquet(f"{base}/in")
    short = spark.read.parquet(f"{base}/in")
    ev.join(short, "event_id", "left_anti").coalesce(1).write.mode("append").parquet(f"{base}/in")
    guard = S.MinRows(spark, 10, write, f"{base}/held")
    q = S.run_available(S.file_stream(spark, f"{base}/in", ev.schema, files_per_trigger=1), f"{base}/ckpt", guard)
    guard.flush(q.lastProgress["batchId"] if q.lastProgress else -1)
    return spark.read.parquet(f"{base}/out").select("event_id")


def _ids(batch):
    return batch.select(F.lit("item").alias("table"), F.get("f_item", F.lit(0)).alias("fid"))


def _gradients(batch, table):
    pred = sigmoid(F.get("label", F.lit(1)) * 4.0 - 1.0)
    g = batch.select(F.lit("item").alias("table"), F.get("f_item", F.lit(0)).alias("fid"), (pred - F.get("label", F.lit(0))).alias("d"))
    return lookup_join(g, table.select("fid", "num"), "fid", "inner").select(
        "table", "fid", F.transform("num", lambda x: x * F.col("d")).alias("grad"))


@query("stream_update", _step_sql("w - 0.05::DOUBLE / sqrt(0.1::DOUBLE + g * g) * g").replace(f"{NOW}::BIGINT", "0::BIGINT"))
def _(spark, d):
    seg = [E.Segment(DIM, "adagrad", (("learning_rate", 0.05),))]
    store = _seed(spark, "update", E.with_empty_state(bind.emb(spark, d), seg))
    _run(spark, "update-run", _samples(spark, d), UP.update_writer(store, _gradients, seg, ids=_ids))
    return _show(store.current())


@query("stream_delta_sync", w(SAMPLES, EMB) + f"""
SELECT 'item' AS "table", fid, {s_vec('num')} AS num FROM (
  SELECT fid, CASE WHEN fid IN (SELECT f_item[1] FROM samples) THEN num ELSE list_transform(num, lambda x: 0.0::DOUBLE) END AS num FROM emb)""")
def _(spark, d):
    store = _seed(spark, "master", bind.emb(spark, d).drop("opt"))
    blank = bind.emb(spark, d).select("table", "fid", F.transform("num", lambda x: F.lit(0.0)).alias("num"))
    serving = _seed(spark, "serving", blank)
    deltas = S.work_dir(spark, "deltas")
    _run(spark, "delta-run", _samples(spark, d), UP.delta_writer(store, _ids, deltas, 7, 8))
    pushed = S.file_stream(spark, deltas, spark.read.parquet(deltas).schema)
    _run(spark, "apply-run", pushed, UP.delta_consumer(serving))
    return serving.current().withColumn("num", vec("num"))


@query("stream_evict", w(EMB) + "SELECT fid, last_update_ts FROM emb WHERE (SELECT max(last_update_ts) FROM emb) - last_update_ts < 5 * 86400")
def _(spark, d):
    store = _seed(spark, "evict", bind.emb(spark, d).drop("opt"))
    _run(spark, "evict-run", _events(spark, d).select("event_id"), UP.evict_every(store, 1, {200: 5}))
    return store.current().select("fid", "last_update_ts")


def _table_rows(spark, d):
    """Updates of the item vectors: the derivative of each sample's loss, to be multiplied with the vector."""
    pred = sigmoid(F.get("label", F.lit(1)) * 4.0 - 1.0)
    rows = _samples(spark, d).select(F.lit("item").alias("table"), F.get("f_item", F.lit(0)).alias("fid"), F.col("req_time").alias("ts"),
                                     (pred - F.get("label", F.lit(0))).alias("d"), F.timestamp_seconds("req_time").alias("at"))
    return K.combined(rows, ["d"], ["ts", "at"])


def _table_run(spark, d, mode="update", **conf):
    """Checkpoint and change files of a run over all events, begun with the stored vectors."""
    base = S.work_dir(spark, "keyed")
    rows = _table_rows(spark, d)
    rows = rows.withWatermark("at", "0 seconds") if "expire_seconds" in conf else rows

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    changes = K.stream_table(rows, lambda num, frame: num * frame["d"].sum(), K.adagrad(0.05), bind.emb(spark, d).drop("opt"), **conf)
    with ST.state_settings(spark, STATE_PARTS):
        S.run_available(changes, f"{base}/ckpt", write, mode=mode)
    return f"{base}/ckpt", f"{base}/out"


_KEYED = """
m AS (SELECT fid, max(s.req_time) AS ts FROM gr JOIN samples s ON s.sample_id = gr.seq GROUP BY 1),
e2 AS (SELECT e.fid, m.fid IS NOT NULL AS hit, greatest(e.last_update_ts, coalesce(m.ts, 0)) AS last_update_ts,
              CASE WHEN m.fid IS NULL THEN e.num ELSE (SELECT list(w - 0.05::DOUBLE / sqrt(0.1::DOUBLE + g * g) * g ORDER BY dim)
                FROM (SELECT merged.dim, e.num[merged.dim + 1] AS w, merged.g FROM merged WHERE merged.fid = e.fid)) END AS num
       FROM emb e LEFT JOIN m ON m.fid = e.fid)"""


@query("stream_table_state", w(SAMPLES, EMB, GRADS, _KEYED) + f"SELECT fid, {s_vec('num')} AS num, last_update_ts FROM e2")
def _(spark, d):
    checkpoint, _out = _table_run(spark, d)
    return K.state_table(spark, checkpoint).select("fid", vec("num").alias("num"), "last_update_ts")


@query("stream_table_changes", w(SAMPLES, EMB, GRADS, _KEYED) + f"SELECT fid, {s_vec('num')} AS num, last_update_ts FROM e2 WHERE hit")
def _(spark, d):
    _checkpoint, out = _table_run(spark, d)
    return K.latest_changes(spark.read.parquet(out)).select("fid", vec("num").alias("num"), "last_update_ts")


@query("stream_table_expiry", w(SAMPLES, EMB, GRADS, _KEYED) + """
SELECT fid, last_update_ts FROM e2 WHERE last_update_ts + 20 * 86400 > (SELECT max(req_time) FROM samples)""")
def _(spark, d):
    checkpoint, _out = _table_run(spark, d, mode="append", expire_seconds=20 * 86400)
    return K.state_table(spark, checkpoint).select("fid", "last_update_ts")


@query("stream_flow_split", w(SAMPLES) + "SELECT sample_id, device_type AS flow FROM samples WHERE device_type IN ('pc', 'cloud')")
def _(spark, d):
    s = _samples(spark, d).select("sample_id", data_source_key("device_type").alias("data_source_key"))
    out = S.work_dir(spark, "flows")
    _run(spark, "flow-run", s, S.flow_writer(["pc", "cloud"], out))
    return spark.read.parquet(out).select("sample_id", "flow")


@query("stream_counters", w(SAMPLES) + f'SELECT count(*) AS "rows", {s_r6("sum(label[1])")} AS positives FROM samples')
def _(spark, d):
    base = S.work_dir(spark, "counters")
    counters = S.counting({"positives": F.sum(F.get("label", F.lit(0)))}, f"{base}/counters")
    S.run_available(_samples(spark, d), f"{base}/ckpt", counters)
    return spark.read.parquet(f"{base}/counters").agg(F.sum("rows").alias("rows"), r6(F.sum("positives")).alias("positives"))


@query("stream_negative_gen", wr(SAMPLES, _pool("chnid + 1", 8)) + f"""
SELECT sample_id, CAST(k AS INT) AS k, new_item AS drawn_item, 'item ' || CAST(new_item AS VARCHAR) AS payload, {s_r6('freq')} AS freq, {s_r6('tf')} AS time_factor FROM hit""")
def _(spark, d):
    s = _samples(spark, d).withColumn("chan", F.col("chnid") + 1)
    pos = N.is_positive(CFG)
    rows = s.select("sample_id", "req_time", "item_id", pos.alias("positive"), pos.alias("cached"),
                    F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("payload"), "chan")
    drawn = ST.stream_negatives(rows, CFG.neg_num, CFG.start_num, CFG.max_item_num, "chan")
    with ST.state_settings(spark, STATE_PARTS):
        out = spark.read.parquet(_run(spark, "negatives", drawn))
    return out.withColumns({"freq": r6("freq"), "time_factor": r6("time_factor")})


_ADMITTED = """
SELECT sample_id, fid, row_number() OVER (PARTITION BY fid ORDER BY req_time, sample_id) - 1 >= 20 AS admitted
FROM (SELECT sample_id, req_time, f_item[1] AS fid FROM samples)"""


@query("stream_admission", w(SAMPLES) + _ADMITTED)
def _(spark, d):
    rows = _samples(spark, d).select("sample_id", "req_time", F.get("f_item", F.lit(0)).alias("fid"))
    with ST.state_settings(spark, STATE_PARTS):
        return spark.read.parquet(_run(spark, "admission", ST.stream_admission(rows, slot_threshold({200: 20}))))


@query("stream_admission_table", w(SAMPLES) + _ADMITTED)
def _(spark, d):
    rows = _samples(spark, d).select("sample_id", "req_time", F.get("f_item", F.lit(0)).alias("fid"))
    counts = _seed(spark, "counts", spark.createDataFrame([], "fid bigint, cnt bigint"))
    out = S.work_dir(spark, "admitted")
    _run(spark, "admission-run", rows, UP.admission_writer(counts, slot_threshold({200: 20}), 20, out))
    return spark.read.parquet(out).select("sample_id", "fid", "admitted")


@query("stream_windowed_counts", w(SAMPLES) + """
SELECT CAST(epoch_us(start) // 1000000 AS BIGINT) AS start_s, fid, count(*) AS cnt
FROM (SELECT TIMESTAMP '1970-01-01' + to_seconds((req_time // 43200 - i) * 43200) AS start, f_item[1] AS fid FROM samples, range(0, 2) t(i)) GROUP BY 1, 2""")
def _(spark, d):
    rows = _samples(spark, d).select(F.timestamp_seconds("req_time").alias("ts"), F.get("f_item", F.lit(0)).alias("fid"))
    base = S.work_dir(spark, "windows")
    counts = ST.windowed_counts(rows, "ts", "24 hours", "12 hours", "400 days").select(F.unix_timestamp("start").alias("start_s"), "fid", "cnt")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    # update mode: a batch writes the windows it changed, and the watermark clears the state of closed ones
    with ST.state_settings(spark, STATE_PARTS):
        S.run_available(counts, f"{base}/ckpt", write, mode="update")
    return spark.read.parquet(f"{base}/out").groupBy("start_s", "fid").agg(F.max_by("cnt", "batch").alias("cnt"))
