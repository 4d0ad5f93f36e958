"""Sinks, each written in full and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.operators import negatives as N
from sampleloom.operators import pooling as P
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import EMB, ORDER_IDS, SAMPLES, read, w
from sampleloom.plans.registry import ints, query, r6, s_ints, s_r6, s_vec, vec
from sampleloom.sources import dump, kafka, text
from sampleloom.sources import table_store as TS
from sampleloom.streaming.flows import work_dir


@query("csv_samples", "SELECT l_partkey AS mov, l_suppkey AS uid, CAST(l_discount AS FLOAT) AS label FROM lineitem")
def _(spark, d):
    path = work_dir(spark, "csv")
    read(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_discount").write.csv(path)
    return text.csv_samples(spark, path)


@query("prediction_dump", w(SAMPLES) + f"""
SELECT CAST(sample_id AS VARCHAR) || chr(9) || CAST(uid AS VARCHAR) || chr(9) || {s_ints('f_tags')} || chr(9) || device_type AS value FROM samples""")
def _(spark, d):
    path = work_dir(spark, "pred")
    text.prediction_dump(bind.samples(spark, d), ["sample_id", "uid", "f_tags", "device_type"], path)
    return spark.read.text(path)


@query("file_metric_sink", w(SAMPLES) + f"""
SELECT 'ctr' AS model, chnid, {s_r6('avg(label[1])')} AS mean_label, count(*) AS n FROM samples GROUP BY 2""")
def _(spark, d):
    path = work_dir(spark, "metrics")
    m = bind.samples(spark, d).groupBy("chnid").agg(F.avg(F.get("label", F.lit(0))).alias("mean_label"), F.count(F.lit(1)).alias("n"))
    dump.metric_dump(m, path, "ctr", "20240101")
    out = spark.read.schema("chnid bigint, mean_label double, n bigint, model string, dt string").json(path)
    return out.select("model", "chnid", r6("mean_label").alias("mean_label"), "n")


@query("feature_dump", w(SAMPLES) + f"SELECT sample_id, {s_ints('f_item')} AS f_item, {s_ints('f_tags')} AS f_tags FROM samples")
def _(spark, d):
    path = work_dir(spark, "features")
    dump.feature_dump(bind.samples(spark, d), ["sample_id", "f_item", "f_tags"], path, 5000)
    return spark.read.parquet(path).select("sample_id", ints("f_item").alias("f_item"), ints("f_tags").alias("f_tags"))


@query("table_save_restore", w(EMB) + f"""
SELECT tbl AS "table", fid, {s_vec('num')} AS num, last_update_ts FROM emb WHERE (SELECT max(last_update_ts) FROM emb) - last_update_ts < 15 * 86400""")
def _(spark, d):
    path = work_dir(spark, "save")
    TS.table_save(bind.emb(spark, d).drop("opt"), path, {200: 15}, buckets=4)
    return TS.table_restore(spark, path).select("table", "fid", vec("num").alias("num"), "last_update_ts")


@query("table_bucketed_lookup", w(EMB, ORDER_IDS) + f"""
SELECT o.row, o.seq, o.fid, {s_vec('coalesce(e.num, list_resize([]::DOUBLE[], 64, 0.0::DOUBLE))')} AS num
FROM oids o LEFT JOIN emb e ON e.fid = o.fid""")
def _(spark, d):
    path = work_dir(spark, "bucketed")
    stored = TS.save_bucketed(bind.emb(spark, d).drop("opt"), path.rsplit("/", 1)[-1].replace("-", "_"), path, 8)
    return P.lookup(bind.order_ids(spark, d), stored, bind.DIM).withColumn("num", vec("num"))


@query("table_restore_max_ts", w(EMB) + "SELECT max(last_update_ts) AS max_update_ts FROM emb")
def _(spark, d):
    path = work_dir(spark, "save")
    TS.table_save(bind.emb(spark, d).drop("opt"), path, buckets=4)
    return TS.max_update_ts(TS.table_restore(spark, path))


@query("pool_save_restore", w(SAMPLES, """
f AS (SELECT chnid + 1 AS channel, item_id AS item, min(struct_pack(a := req_time, b := sample_id)) AS fa, count(*) AS c FROM samples GROUP BY 1, 2)""") + """
SELECT channel, item, seq, CAST(2 * c AS BIGINT) AS origin_cnt FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY fa) AS seq FROM f)""")
def _(spark, d):
    paths = [work_dir(spark, "pool") for _ in range(2)]
    pool = N.pool_state(bind.samples(spark, d).withColumn("chan", F.col("chnid") + 1), "chan", "item_id", 5, 1000)
    for p in paths:
        TS.pool_save(pool.select("channel", "item", "seq", "origin_cnt"), p, 3)
    return TS.pool_restore(spark, paths)


@query("item_vector_dump", w(EMB) + f"""
SELECT 'item_vector' AS "table", vec_id AS fid, {s_vec('list_concat([num[1] * 2.0::DOUBLE], num)')} AS num FROM emb""")
def _(spark, d):
    path = work_dir(spark, "vectors")
    e = read(spark, d, "embeddings").withColumn("bias", F.get("embedding", F.lit(0)).cast("double") * 2.0)
    dump.item_vector_dump(e, "vec_id", "bias", "embedding", path)
    return spark.read.parquet(path).select("table", "fid", vec("num").alias("num"))


@query("message_codec", w(SAMPLES) + "SELECT sample_id, uid, device_type FROM samples")
def _(spark, d):
    # what a topic would carry: JSON values, with broken messages dropped on the way back
    msgs = kafka.encode(bind.samples(spark, d).select("sample_id", "uid", "device_type"), "uid")
    broken = msgs.select("key", F.lit("").alias("value"))
    raw = msgs.unionByName(broken).withColumn("value", F.col("value").cast("binary"))
    return kafka.decode(raw, "sample_id bigint, uid bigint, device_type string")
