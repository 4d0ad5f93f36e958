"""Lookups and pooling of ragged features."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import vectors as V
from sampleloom.functions.fid import make_fid
from sampleloom.operators import gradients as G
from sampleloom.operators import pooling as P
from sampleloom.operators import tables as E
from sampleloom.operators.ordering import first_in_key
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import DIM, EMB, GRADS, ORDER_IDS, SAMPLES, w
from sampleloom.plans.registry import query, r6, s_r6, s_vec, vec

_LOOKED = """
looked AS (
  SELECT o.row, o.seq, o.fid, i AS dim, coalesce(e.num[i + 1], 0.0::DOUBLE) AS x
  FROM (oids o LEFT JOIN emb e ON e.fid = o.fid), range(0, 64) t(i))"""


def _vec_of(inner: str, keys: str, x: str = "x") -> str:
    """SQL that folds (keys, dim, x) rows into one text vector per key."""
    return (f"SELECT {keys}, string_agg(CAST(CAST(floor({x} * 1000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR), ',' "
            f"ORDER BY dim) AS num FROM ({inner}) GROUP BY {keys}")


def _looked(spark, d, row_key=None):
    return P.lookup(bind.order_ids(spark, d), bind.emb(spark, d), DIM, row_key=row_key)


@query("embedding_lookup", w(EMB, ORDER_IDS) + f"""
SELECT o.row, o.seq, o.fid, {s_vec('coalesce(e.num, list_resize([]::DOUBLE[], 64, 0.0::DOUBLE))')} AS num
FROM oids o LEFT JOIN emb e ON e.fid = o.fid""")
def _(spark, d):
    return _looked(spark, d).withColumn("num", vec("num"))


@query("dedup_lookup", w(EMB, ORDER_IDS) + f"""
SELECT o.row, o.seq, o.fid, {s_vec('coalesce(e.num, list_resize([]::DOUBLE[], 64, 0.0::DOUBLE))')} AS num
FROM oids o LEFT JOIN emb e ON e.fid = o.fid""")
def _(spark, d):
    return P.dedup_lookup(bind.order_ids(spark, d), bind.emb(spark, d), DIM).withColumn("num", vec("num"))


def _two_tables(spark, d):
    e = bind.emb(spark, d).select("table", "fid", "num")
    half = e.select(F.lit("half").alias("table"), "fid", F.slice("num", 1, 32).alias("num"))
    return e.unionByName(half)


@query("multi_table_lookup", w(EMB, ORDER_IDS) + f"""
SELECT o.row, o.seq, o.tbl AS "table", o.fid, CASE WHEN o.tbl = 'item' THEN {s_vec('coalesce(e.num, list_resize([]::DOUBLE[], 64, 0.0::DOUBLE))')}
       ELSE {s_vec('coalesce(e.num[1:32], list_resize([]::DOUBLE[], 32, 0.0::DOUBLE))')} END AS num
FROM (SELECT *, CASE WHEN seq % 2 = 0 THEN 'item' ELSE 'half' END AS tbl FROM oids) o LEFT JOIN emb e ON e.fid = o.fid""")
def _(spark, d):
    ids = bind.order_ids(spark, d).withColumn("table", F.when(F.col("seq") % 2 == 0, "item").otherwise("half"))
    return P.multi_table_lookup(ids, _two_tables(spark, d), {"item": 64, "half": 32}).withColumn("num", vec("num"))


@query("lookup_entry", w(EMB, ORDER_IDS) + f"""
SELECT tbl AS "table", fid, {s_vec('num')} AS num, {s_vec('list_transform(num, lambda x: x * x + 0.1::DOUBLE)')} AS norm, last_update_ts
FROM emb WHERE fid IN (SELECT fid FROM oids)""")
def _(spark, d):
    ids = bind.order_ids(spark, d).select(F.lit("item").alias("table"), "fid")
    stored = bind.emb(spark, d).withColumn("opt", F.struct(F.transform("num", lambda x: x * x + 0.1).alias("norm")))
    return E.lookup_entry(ids, stored).select("table", "fid", vec("num").alias("num"), vec("opt.norm").alias("norm"), "last_update_ts")


@query("contains", w(EMB, ORDER_IDS) + "SELECT row, seq, fid IN (SELECT fid FROM emb) AS present FROM oids")
def _(spark, d):
    ids = bind.order_ids(spark, d).withColumn("table", F.lit("item"))
    t = bind.emb(spark, d)
    yes = E.contains(ids, t).select("row", "seq", F.lit(True).alias("present"))
    return yes.unionByName(E.contains(ids, t, False).select("row", "seq", F.lit(False).alias("present")))


@query("pool_sum", w(EMB, ORDER_IDS, _LOOKED) + _vec_of("SELECT row, dim, sum(x) AS x FROM looked GROUP BY row, dim", "row"))
def _(spark, d):
    return P.pool(_looked(spark, d, "row"), "row", DIM).withColumn("num", vec("num"))


@query("pool_mean", w(EMB, ORDER_IDS, _LOOKED) + _vec_of("SELECT row, dim, sum(x) / count(*) AS x FROM looked GROUP BY row, dim", "row"))
def _(spark, d):
    return P.pool(_looked(spark, d, "row"), "row", DIM, "mean").withColumn("num", vec("num"))


@query("pool_sqrt_sum_sq", w(EMB, ORDER_IDS, _LOOKED) + _vec_of("SELECT row, dim, sqrt(sum(x * x)) AS x FROM looked GROUP BY row, dim", "row"))
def _(spark, d):
    return P.pool(_looked(spark, d, "row"), "row", DIM, "sqrt_sum_sq").withColumn("num", vec("num"))


@query("pool_first_n", w(EMB, ORDER_IDS, """
firsts AS (SELECT row, rn, fid FROM (SELECT row, fid, row_number() OVER (PARTITION BY row ORDER BY seq, fid) AS rn FROM oids) WHERE rn <= 2)""") + f"""
SELECT r.row, {s_vec('coalesce(a.num, z)')} AS first_vec, {s_vec('coalesce(b.num, z)')} AS second_vec
FROM (SELECT DISTINCT row, list_resize([]::DOUBLE[], 64, 0.0::DOUBLE) AS z FROM oids) r
LEFT JOIN firsts f1 ON f1.row = r.row AND f1.rn = 1 LEFT JOIN emb a ON a.fid = f1.fid
LEFT JOIN firsts f2 ON f2.row = r.row AND f2.rn = 2 LEFT JOIN emb b ON b.fid = f2.fid""")
def _(spark, d):
    every = bind.order_ids(spark, d)
    ids = first_in_key(every, ["row"], 2, [F.col("seq"), F.col("fid")], "pos").withColumn("pos", F.col("pos") - 1)
    out = P.first_n(ids, bind.emb(spark, d), "row", DIM, 2, named=every)
    return out.select("row", vec(F.get("nums", F.lit(0))).alias("first_vec"), vec(F.get("nums", F.lit(1))).alias("second_vec"))


def _tag_ids(spark, d):
    s = bind.samples(spark, d)
    ids = s.select("sample_id", F.transform("f_tags", lambda f: make_fid(200, f % 1000)).alias("ids"))
    return P.explode_ids(ids, "sample_id", "ids")


_TAGS = """
tg AS (SELECT sample_id, i AS pos, (200::BIGINT << 48) + f_tags[i + 1] % 1000 AS fid
       FROM samples, range(0, 4) t(i) WHERE i < len(f_tags))""", """
tl AS (SELECT tg.sample_id, tg.pos, tg.fid, i AS dim, coalesce(e.num[i + 1], 0.0::DOUBLE) AS x
       FROM (tg LEFT JOIN emb e ON e.fid = tg.fid), range(0, 64) t(i))""", """
ts AS (SELECT sample_id, dim, sum(x * x) AS sq, count(*) AS n FROM tl GROUP BY 1, 2)"""


def _pool_grad(spark, d, how):
    looked = P.lookup(_tag_ids(spark, d), bind.emb(spark, d), DIM, row_key="sample_id")
    row = bind.samples(spark, d).select("sample_id", F.transform(
        F.sequence(F.lit(1), F.lit(DIM)), lambda i: F.get("label", F.lit(1)) * i).alias("grad"))
    return P.pool_gradients(looked, row, "sample_id", DIM, how).withColumn("grad", vec("grad"))


def _grad_sql(expr: str) -> str:
    return w(SAMPLES, EMB, *_TAGS) + _vec_of(f"""
SELECT tl.sample_id, CAST(tl.pos AS INT) AS pos, tl.fid, tl.dim, {expr} AS x
FROM tl JOIN ts ON ts.sample_id = tl.sample_id AND ts.dim = tl.dim JOIN samples s ON s.sample_id = tl.sample_id""",
                                             "sample_id, pos, fid").replace("AS num", "AS grad")


@query("pool_gradients", _grad_sql("s.label[2] * (tl.dim + 1) * CASE WHEN ts.sq > 0 THEN tl.x / sqrt(ts.sq) ELSE 0 END"))
def _(spark, d):
    return _pool_grad(spark, d, "sqrt_sum_sq")


@query("pool_gradients_mean", _grad_sql("s.label[2] * (tl.dim + 1) / ts.n"))
def _(spark, d):
    return _pool_grad(spark, d, "mean")


@query("pool_gradients_sum", _grad_sql("s.label[2] * (tl.dim + 1)"))
def _(spark, d):
    return _pool_grad(spark, d, "sum")


@query("segment_sum", w(SAMPLES, EMB, """
g AS (SELECT s.chnid, i AS dim, sum(e.num[i + 1]) AS x FROM samples s JOIN emb e ON e.fid = s.f_item[1], range(0, 64) t(i) GROUP BY 1, 2)""")
       + _vec_of("SELECT * FROM g WHERE dim < 16", "chnid").replace("AS num", "AS part0")
       .replace("SELECT chnid", "SELECT p0.*, p1.part1 FROM (SELECT chnid", 1)
       + ") p0 JOIN (" + _vec_of("SELECT * FROM g WHERE dim >= 16", "chnid").replace("AS num", "AS part1") + ") p1 ON p0.chnid = p1.chnid")
def _(spark, d):
    s = bind.samples(spark, d).select("chnid", F.get("f_item", F.lit(0)).alias("fid"))
    j = s.join(bind.emb(spark, d).select("fid", "num"), "fid")
    out = P.segment_sum(j, "chnid", "num", DIM, [16, 48])
    return out.select("chnid", vec("part0").alias("part0"), vec("part1").alias("part1"))


@query("embedding_slice", w(EMB) + f"SELECT fid, {s_vec('num[1:1]')} AS bias, {s_vec('num[2:17]')} AS body, {s_vec('num[18:64]')} AS tail FROM emb")
def _(spark, d):
    spans = {"bias": (0, 1), "body": (1, 17), "tail": (17, 64)}
    cut = bind.emb(spark, d).select("fid", *P.slices("num", spans))
    return cut.select("fid", *[vec(n).alias(n) for n in spans])


#: The 64 elements as eight parts of eight.
_EIGHTHS = range(0, DIM, 8)
_ADDED = " + ".join(f"num[i + {a}]" for a in _EIGHTHS)


@query("embedding_layout", w(EMB) + f"""
SELECT fid, {s_vec('num')} AS joined, {s_vec(f'list_transform(range(1, 9), lambda i: {_ADDED})')} AS added,
       {s_vec('num[9:16]')} AS stacked_second
FROM emb""")
def _(spark, d):
    parts = [V.piece("num", a, a + 8) for a in _EIGHTHS]
    return bind.emb(spark, d).select("fid", vec(P.layout(parts, "concat")).alias("joined"), vec(P.layout(parts, "addn")).alias("added"),
                                     vec(F.get(P.layout(parts, "stack"), F.lit(1))).alias("stacked_second"))


_PAIRS = [(a, b) for a in _EIGHTHS[:4] for b in _EIGHTHS[4:]]


@query("field_interaction", w(EMB) + f"""
SELECT fid, {s_vec("[" + ", ".join(f"num[{a + i}] * num[{b + i}]" for a, b in _PAIRS for i in range(1, 9)) + "]")} AS products,
       {s_vec("[" + ", ".join(f"list_dot_product(num[{a + 1}:{a + 8}], num[{b + 1}:{b + 8}])" for a, b in _PAIRS) + "]")} AS dots
FROM emb""")
def _(spark, d):
    left = [V.piece("num", a, a + 8) for a in _EIGHTHS[:4]]
    right = [V.piece("num", a, a + 8) for a in _EIGHTHS[4:]]
    return bind.emb(spark, d).select("fid", vec(P.field_interaction(left, right)).alias("products"),
                                     vec(P.field_interaction(left, right, "dot")).alias("dots"))


@query("cross_feature_pooling", w(EMB) + f"""
SELECT fid, {s_vec(f'list_transform(range(1, 9), lambda i: {_ADDED})')} AS summed,
       {s_vec(f'list_transform(range(1, 9), lambda i: ({_ADDED}) / 8.0::DOUBLE)')} AS averaged,
       {s_vec('list_transform(range(1, 9), lambda i: greatest(' + ", ".join(f"num[i + {a}]" for a in _EIGHTHS) + '))')} AS maxed
FROM emb""")
def _(spark, d):
    parts = [V.piece("num", a, a + 8) for a in _EIGHTHS]
    return bind.emb(spark, d).select("fid", vec(V.fold(parts, "sum")).alias("summed"), vec(V.fold(parts, "avg")).alias("averaged"),
                                     vec(V.fold(parts, "max")).alias("maxed"))


_W = [[(i % 5) * 0.25, (i % 3) - 1.0] for i in range(64)]


@query("feature_insight", w(EMB) + "SELECT fid, " + s_vec("[" + ", ".join(
    f"list_dot_product(num[{a + 1}:{b}], [" + ", ".join(f"{_W[i][k]}::DOUBLE" for i in range(a, b)) + "])"
    for a, b in ((0, 16), (16, 40), (40, 64)) for k in (0, 1)) + "]") + " AS insight FROM emb")
def _(spark, d):
    return bind.emb(spark, d).select("fid", vec(P.feature_insight("num", _W, [16, 24, 24])).alias("insight"))


@query("merge_gradients", w(SAMPLES, EMB, GRADS) + _vec_of("SELECT fid, dim, g AS x FROM merged", "fid").replace("AS num", "AS grad"))
def _(spark, d):
    return G.merge_gradients(bind.gradients(spark, d), DIM).withColumn("grad", vec("grad"))


@query("global_norm_clip", w(SAMPLES, EMB, GRADS, """
n AS (SELECT sqrt(sum(g * g)) AS norm FROM merged)""") + _vec_of(
    "SELECT fid, dim, g * 5.0::DOUBLE / greatest(norm, 5.0::DOUBLE) AS x, " + s_r6("norm") + " AS global_norm FROM merged, n",
    "fid, global_norm").replace("AS num", "AS grad"))
def _(spark, d):
    merged = G.merge_gradients(bind.gradients(spark, d), DIM)
    return G.clip_by_global_norm(merged, 5.0).select("fid", r6("global_norm").alias("global_norm"), vec("grad").alias("grad"))
