"""Scans and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.operators import batches as B
from sampleloom.operators import samples as S
from sampleloom.operators.joins import context_join
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import SAMPLES, read, w
from sampleloom.plans.registry import ints, query, s_ints, s_u32, s_vec, vec
from sampleloom.sources.feature_meta import prune_features
from sampleloom.sources.parquet import date_range, exclude_files, read_patterns, scan_parquet, shard_files
from sampleloom.sources.text import ingest_ratings
from sampleloom.streaming.flows import work_dir


@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 45")
def _(spark, d):
    df = scan_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"],
                      ["fid_v2", "int", "float", "bytes"])
    return df.filter("l_quantity > 45")


@query("scan_fixed_batches", """
SELECT event_id, CAST((rn - 1) // 512 AS BIGINT) AS batch_no
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS n FROM events)
WHERE (rn - 1) // 512 < n // 512""")
def _(spark, d):
    return B.count_window(read(spark, d, "events").select("event_id"), [], ["event_id"], 512)


def _monthly(spark, d):
    """Orders in one folder for each month, as a store keeps them."""
    path = work_dir(spark, "orders")
    o = read(spark, d, "orders").withColumn("dt", F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd"))
    o.select("o_orderkey", "o_totalprice", "dt").repartition("dt").write.partitionBy("dt").parquet(path)
    return path


@query("scan_date_range", """
SELECT o_orderkey, o_totalprice, strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS dt FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""")
def _(spark, d):
    stored = spark.read.schema("o_orderkey bigint, o_totalprice double, dt string").parquet(_monthly(spark, d))
    return date_range(stored, "19970101", "19970701").select("o_orderkey", "o_totalprice", "dt")


@query("expand_patterns", """
SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def _(spark, d):
    # days without a folder are skipped
    return read_patterns(spark, [f"{_monthly(spark, d)}/dt={{DATE(19970101,19970331)}}"]).select("o_orderkey")


def _by_type(spark, d):
    path = work_dir(spark, "events")
    read(spark, d, "events").select("event_id", "event_type").repartition(1).write.partitionBy("event_type").parquet(path)
    return path


@query("exclude_files", "SELECT event_id FROM events WHERE event_type <> 'error'")
def _(spark, d):
    df = spark.read.parquet(_by_type(spark, d)).select("event_id")
    return exclude_files(df, lambda f: "/event_type=error/" in f, whole_path=True)


@query("shard_files", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup')")
def _(spark, d):
    return shard_files(spark, _by_type(spark, d), 2, 1).select("event_id")


@query("shard_rows", f"SELECT event_id FROM events WHERE {s_u32('CAST(event_id AS VARCHAR)')} % 4 = 1")
def _(spark, d):
    return S.shard_rows(read(spark, d, "events").select("event_id"), "event_id", 4, 1)


@query("drop_empty", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND length(text) > 0")
def _(spark, d):
    return S.drop_empty(read(spark, d, "documents").select("doc_id", "text"), "text")[0].select("doc_id")


@query("ingest_ratings", """
SELECT CAST('0x' || substr(md5(p_name), 1, 15) AS BIGINT) AS mov,
       CAST('0x' || substr(md5(CAST(l_suppkey AS VARCHAR)), 1, 15) AS BIGINT) AS uid, l_quantity AS label
FROM lineitem JOIN part ON p_partkey = l_partkey""")
def _(spark, d):
    li = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    j = li.join(read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    return ingest_ratings(j, "p_name", "l_suppkey", "l_quantity", portable=True)


@query("convert_rows", w(SAMPLES) + f"""
SELECT sample_id, 'fc_slot_' || CAST(slot AS VARCHAR) AS name, {s_ints('list(f ORDER BY pos)')} AS ids, instance_weight
FROM (SELECT sample_id, instance_weight, fids_v1[i] AS f, i AS pos, [301, 200, 1, 1000][i] AS slot
      FROM samples, range(1, 5) t(i))
GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY sample_id, slot, instance_weight"))
def _(spark, d):
    s = bind.samples(spark, d).select("sample_id", "instance_weight", S.fids_to_map("fids_v1").alias("m"))
    return s.select("sample_id", F.coalesce("instance_weight", F.lit(1.0)).alias("instance_weight"),
                    F.explode("m").alias("name", "ids")).withColumn("ids", ints("ids"))


@query("convert_rows_back", w(SAMPLES) + f"SELECT sample_id, {s_ints('list_sort(fids_v1)')} AS ids FROM samples")
def _(spark, d):
    s = bind.samples(spark, d).select("sample_id", S.fids_to_map("fids_v1").alias("m"))
    return s.select("sample_id", ints(F.sort_array(S.map_to_fids("m"))).alias("ids"))


@query("tf_example_to_example", f"""
SELECT l_orderkey, l_linenumber, (11::BIGINT << 48) + l_partkey AS l_partkey,
       (12::BIGINT << 48) + CAST(floor(log2(abs(l_extendedprice) + 1)) AS BIGINT) AS l_extendedprice,
       l_tax, l_discount, l_quantity AS instance_weight
FROM lineitem""")
def _(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax",
                                           "l_discount", "l_quantity")
    out = S.flat_to_sample(li, {"l_partkey": 11, "l_extendedprice": 12}, ["l_tax"], "l_discount", "l_quantity",
                           ["l_orderkey", "l_linenumber"])
    for c in ("l_partkey", "l_extendedprice"):
        out = out.withColumn(c, F.get(c, F.lit(0)))
    return out


def _with_line_id(spark, d):
    return bind.samples(spark, d).withColumn("line_id", F.struct(
        "uid", "req_time", "item_id", "chnid", "actions", "special_strategies", "sample_rate", "rank", "device_type"))


@query("parse_samples", w(SAMPLES) + f"""
SELECT sample_id, {s_ints('f_item')} AS f_item, {s_ints('f_tags')} AS f_tags, label[1] AS label, uid, sample_rate,
       {s_ints('actions')} AS actions
FROM samples""")
def _(spark, d):
    out = S.parse_samples(_with_line_id(spark, d), S.Layout(("f_item", "f_tags"), {"label": (1, "float")}, {
        "uid": 0, "sample_rate": 0, "actions": 1}), ["sample_id"])
    return out.select("sample_id", ints("f_item").alias("f_item"), ints("f_tags").alias("f_tags"), "label", "uid",
                      "sample_rate", ints("actions").alias("actions"))


@query("dense_fixed_shape", w(SAMPLES) + f"""
SELECT sample_id, {s_vec('list_resize(label, 3, 0.0::DOUBLE)')} AS padded, label[1] AS cut,
       (CASE WHEN sample_id % 2 = 0 THEN label[2] ELSE 1.1754943508222875e-38::DOUBLE END) AS sparse_value
FROM samples""")
def _(spark, d):
    s = bind.samples(spark, d)
    half = F.when(F.col("sample_id") % 2 == 0, F.slice("label", 2, 1)).otherwise(F.array().cast("array<double>"))
    return s.select("sample_id", vec(S.dense_column("label", 3)).alias("padded"), S.dense_column("label", 1).alias("cut"),
                    S.dense_column(half, 1).alias("sparse_value"))


@query("line_id_fields", w(SAMPLES) + f"""
SELECT sample_id, uid, req_time, rank, device_type, {s_ints('special_strategies[1:1]')} AS special_strategies FROM samples""")
def _(spark, d):
    s = _with_line_id(spark, d)
    cols = {n: 1 for n in ("uid", "req_time", "rank", "device_type", "special_strategies")}
    out = S.parse_samples(s, S.Layout(extra=cols), ["sample_id"])
    return out.withColumn("special_strategies", ints("special_strategies"))


@query("select_by_fids", w(SAMPLES) + f"""
SELECT sample_id, 'f_item' AS name, {s_ints('f_item')} AS ids FROM samples
UNION ALL SELECT sample_id, 'f_tags', {s_ints('f_tags')} FROM samples""")
def _(spark, d):
    s = bind.samples(spark, d)
    named = [("f_item", 200), ("f_user", 1), ("f_tags", 5)]
    rows = s.select("sample_id", F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("slot"), F.col(n).alias("ids"))
                                                    for n, t in named])))
    want = [(200 << 48) + 3, (5 << 48) + 9]
    return S.select_by_fids(rows, want).select("sample_id", "name", ints("ids").alias("ids"))


def _batched(spark, d):
    s = bind.samples(spark, d).select("sample_id", "item_id", "chnid")
    return B.count_window(s, [], ["sample_id"], 128, drop_remainder=False)


@query("rows_to_batches", w(SAMPLES) + f"""
SELECT b AS batch_no, CAST(count(*) AS INT) AS batch_size, {s_ints('list(item_id ORDER BY sample_id)')} AS item_id,
       {s_ints('list(chnid ORDER BY sample_id)')} AS chnid
FROM (SELECT *, CAST((row_number() OVER (ORDER BY sample_id) - 1) // 128 AS BIGINT) AS b FROM samples) GROUP BY b""")
def _(spark, d):
    out = B.rows_to_batches(_batched(spark, d), "batch_no", "sample_id", ["item_id", "chnid"])
    return out.select("batch_no", "batch_size", ints("item_id").alias("item_id"), ints("chnid").alias("chnid"))


@query("batches_to_rows", w(SAMPLES) + """
SELECT b AS batch_no, CAST(pos AS INT) AS pos, item_id, chnid, b * 10 AS shared
FROM (SELECT *, (rn - 1) // 128 AS b, (rn - 1) % 128 AS pos
      FROM (SELECT *, row_number() OVER (ORDER BY sample_id) AS rn FROM samples))""")
def _(spark, d):
    wide = B.rows_to_batches(_batched(spark, d), "batch_no", "sample_id", ["item_id", "chnid"])
    context = wide.select("batch_no", (F.col("batch_no") * 10).alias("shared"))
    return B.batches_to_rows(wide, "batch_no", ["item_id", "chnid"], context)


@query("explode_request", w(SAMPLES) + """
SELECT sample_id, uid, CAST(i AS INT) AS pos, f_tags[i + 1] AS fid, i * 2 AS score FROM samples, range(0, 4) t(i)
WHERE i < len(f_tags)""")
def _(spark, d):
    req = bind.samples(spark, d).select("sample_id", "uid", F.transform("f_tags", lambda f, i: F.struct(
        f.alias("fid"), (i * 2).cast("bigint").alias("score"))).alias("instances"))
    return S.explode_request(req, ["sample_id", "uid"], "instances")


@query("context_join", """
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""")
def _(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return context_join(li, o, "l_orderkey")


@query("use_field_as_label", w(SAMPLES) + f"""
SELECT sample_id, CASE WHEN rank >= 5 THEN 0.0::DOUBLE ELSE CAST(rank AS DOUBLE) END AS label FROM samples""")
def _(spark, d):
    from sampleloom.functions.labels import field_as_label

    return bind.samples(spark, d).select("sample_id", F.get(field_as_label("rank", 5.0), F.lit(0)).alias("label"))


@query("parse_batches_with_labels", w(SAMPLES) + """
SELECT sample_id, src, CASE WHEN actions[1] IN (2, 4) THEN 1.0::DOUBLE WHEN actions[1] = 1 THEN -1.0::DOUBLE
                            ELSE -3.4028234663852886e38::DOUBLE END AS task0,
       CASE WHEN actions[1] = 3 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS task1
FROM (SELECT *, 'even' AS src FROM samples WHERE is_draw UNION ALL SELECT *, 'odd' FROM samples WHERE NOT is_draw)""")
def _(spark, d):
    from sampleloom.functions.labels import labels_from_actions

    s = bind.samples(spark, d).select("sample_id", "actions", "is_draw")
    parts = {"even": s.filter("is_draw"), "odd": s.filter("not is_draw")}
    both = [p.withColumn("src", F.lit(n)) for n, p in parts.items()]
    lab = labels_from_actions("actions", "2,4:1:1.0;3::1.0", 1.0, -1.0)
    return both[0].unionByName(both[1]).select("sample_id", "src", F.get(lab, F.lit(0)).alias("task0"),
                                               F.get(lab, F.lit(1)).alias("task1"))


@query("prune_features", w(SAMPLES) + f"SELECT sample_id, {s_ints('f_item')} AS f_item, {s_ints('f_tags')} AS f_tags FROM samples")
def _(spark, d):
    out = prune_features(bind.samples(spark, d), ["item", "tags"], ["sample_id"])
    return out.select("sample_id", ints("f_item").alias("f_item"), ints("f_tags").alias("f_tags"))
